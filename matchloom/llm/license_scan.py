"""License scans with ordered signature rules.

A text is reduced to its words (A-Z lower-cased, other ASCII signs become gaps), joined
by single spaces. Every rule is a regular expression over those words with keywords,
one for each of its alternatives, of which one must occur before the expression is tried at
all; most texts fail all keywords and cost one byte-table pass and a few substring searches. Detections are then resolved: one
whose interval lies inside that of a rule of higher priority - or of the same priority
and longer, or equal and earlier in the table - is suppressed. The phrases of BASE are
rules as well, but they always stay.

Cases: a null or empty text has no words, no labels and score 0; labels are distinct and
sorted; very long texts are scanned whole, in linear time but for the word positions of
actual hits; repeated rows are scanned one by one; an empty table gives an empty result;
extra columns of the input are not returned.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents
from .textvec import LOWER, NON_ALNUM, slices

#: Phrases whose every place counts, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: label -> (keywords, expression of the license's name in plain words); each way to match holds one of the keywords.
NAMES = {
    "mit": ("mit expat x11", r"(?:the )?(?:mit|expat|x11)"),
    "mit-0": ("mit", r"mit (?:0|no attribution)"),
    "apache-1.1": ("apache", r"apache(?: software)?(?: license)?(?: version)? 1 1"),
    "apache-2.0": ("apache", r"apache(?: software)?(?: license)?(?: version| v)? ?v?2(?: 0)?"),
    "apache": ("apache", r"apache(?: software)?(?: foundation)?"),
    "bsd-2-clause": ("bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)"),
    "bsd-3-clause": ("bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)"),
    "bsd-4-clause": ("bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)"),
    "bsd-0-clause": ("bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)"),
    "bsd": ("bsd", r"bsd(?: style)?"),
    "isc": ("isc", r"isc"),
    "gpl-1.0": ("general", r"(?:gnu )?general public license(?: version| v)? ?v?1(?: 0)?"),
    "gpl-2.0": ("general", r"(?:gnu )?general public license(?: version| v)? ?v?2(?: 0)?"),
    "gpl-3.0": ("general", r"(?:gnu )?general public license(?: version| v)? ?v?3(?: 0)?"),
    "gpl": ("general", r"(?:gnu )?general public"),
    "gpl-2.0-only": ("gpl", r"gpl ?v?(?:version )?2(?: 0)?(?: only)?"),
    "gpl-3.0-only": ("gpl", r"gpl ?v?(?:version )?3(?: 0)?(?: only)?"),
    "lgpl-2.0": ("gnu", r"gnu library general public license(?: version| v)? ?v?2(?: 0)?"),
    "lgpl-2.1": ("lesser", r"(?:gnu )?lesser general public license(?: version| v)? ?v?2 1"),
    "lgpl-3.0": ("lesser", r"(?:gnu )?lesser general public license(?: version| v)? ?v?3(?: 0)?"),
    "lgpl": ("lgpl", r"(?:gnu )?lgpl(?: v?[23](?: [01])?)?"),
    "agpl-3.0": ("affero", r"(?:gnu )?affero general public license(?: version| v)? ?v?3(?: 0)?"),
    "agpl": ("agpl", r"(?:gnu )?agpl(?: v?3(?: 0)?)?"),
    "fdl": ("gnu", r"gnu free documentation(?: license)?(?: version| v)?(?: 1 [123])?"),
    "mpl-1.1": ("mozilla", r"mozilla public license(?: version| v)? ?v?1 [01]"),
    "mpl-2.0": ("mozilla", r"mozilla public license(?: version| v)? ?v?2(?: 0)?"),
    "mpl": ("mozilla", r"mozilla public"),
    "epl-1.0": ("eclipse", r"eclipse public license(?: version| v)? ?v?1(?: 0)?"),
    "epl-2.0": ("eclipse", r"eclipse public license(?: version| v)? ?v?2(?: 0)?"),
    "eupl": ("european", r"european union public(?: license| licence)?(?: version| v)?(?: 1 [012])?"),
    "cddl": ("development", r"common development and distribution(?: license)?(?: version| v)?(?: 1 [01])?"),
    "cpl": ("common", r"common public license(?: version| v)?(?: 1 0)?"),
    "artistic": ("artistic", r"artistic(?: license)?(?: version| v)?(?: [12] 0)?"),
    "zlib": ("zlib", r"zlib(?: libpng)?"),
    "boost": ("boost", r"boost software(?: license)?(?: version| v)?(?: 1 0)?"),
    "unlicense": ("unlicense", r"unlicense"),
    "wtfpl": ("wtfpl", r"wtfpl"),
    "python": ("python", r"python software foundation"),
    "ofl": ("sil", r"sil open font(?: license)?(?: version| v)?(?: 1 1)?"),
    "odbl": ("open", r"open (?:data commons open )?database(?: license)?(?: v?1 0)?"),
    "cc0-1.0": ("cc0 zero", r"(?:cc0|creative commons zero)(?: v?1 0)?(?: universal)?"),
    "cc-by-4.0": ("cc commons", r"(?:cc by|creative commons attribution) 4 0(?: international)?"),
    "cc-by-3.0": ("cc commons", r"(?:cc by|creative commons attribution) 3 0(?: unported)?"),
    "cc-by-sa": ("cc", r"cc by sa(?: \d \d)?"),
    "cc-by-nc": ("cc", r"cc by nc(?: \d \d)?"),
    "cc-by-nd": ("cc", r"cc by nd(?: \d \d)?"),
    "cc-by-nc-sa": ("cc", r"cc by nc sa(?: \d \d)?"),
    "cc-by-nc-nd": ("cc", r"cc by nc nd(?: \d \d)?"),
    "cc-attribution-sharealike": ("commons", r"creative commons attribution share ?alike(?: \d \d)?"),
    "cc-attribution-noncommercial": ("commons", r"creative commons attribution non ?commercial(?: share ?alike| no ?deriv(?:ative)?s)?(?: \d \d)?"),
    "proprietary": ("proprietary", r"proprietary"),
}
#: (form, priority, expression; N stands for the license's name)
FORMS = [
    ("notice", 5, r"(?:is |are |be )?(?:licen[sc]ed|released|distributed|published|made available|provided) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?N(?: licen[sc]e)?"),
    ("terms", 4, r"(?:subject to|governed by|in accordance with|according to) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?N licen[sc]e"),
    ("tag", 5, r"(?:spdx )?licen[sc]e (?:identifier )?N"),
    ("see", 3, r"see (?:the )?N(?: licen[sc]e)? for (?:more |further )?(?:details|information|terms)"),
    ("copy", 4, r"(?:copy|text|version) of (?:the )?N licen[sc]e"),
    ("name", 2, r"N licen[sc]e"),
]
#: Clauses: (label, keywords, priority, expression)
CLAUSES = [
    ("mit", "hereby", 4, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "distribute", 4, r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", 4, r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "endorse", 3, r"neither the names? of .{1,80}? may be used to endorse or promote products"),
    ("apache-2.0", "apache", 4, r"www apache org licenses license 2 0"),
    ("gpl", "gnu", 4, r"www gnu org licenses gpl(?: [23] 0)?"),
    ("gpl", "redistribute", 4, r"free software you can redistribute it and or modify it"),
    ("lgpl", "gnu", 4, r"www gnu org licenses lgpl(?: [23] [01])?"),
    ("mpl-2.0", "mozilla", 4, r"mozilla org mpl 2 0"),
    ("cc0-1.0", "publicdomain", 4, r"creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons", 4, r"creativecommons org licenses by \d \d"),
    ("cc-by-sa", "creativecommons", 4, r"creativecommons org licenses by sa \d \d"),
    ("cc-by-nc", "creativecommons", 4, r"creativecommons org licenses by nc \d \d"),
    ("cc-by-nc-sa", "creativecommons", 4, r"creativecommons org licenses by nc sa \d \d"),
    ("cc-by-nd", "creativecommons", 4, r"creativecommons org licenses by nd \d \d"),
    ("cc-by-nc-nd", "creativecommons", 4, r"creativecommons org licenses by nc nd \d \d"),
    ("public-domain", "domain", 3, r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("public-domain", "domain", 2, r"(?:is|are) in the public domain"),
    ("unlicense", "unencumbered", 4, r"free and unencumbered software released into the public domain"),
    ("zlib", "altered", 4, r"altered source versions must be plainly marked as such"),
    ("boost", "boost", 4, r"www boost org license 1 0 txt"),
    ("warranty-disclaimer", "warranty", 2, r"without warranty of any kind"),
    ("warranty-disclaimer", "warranties", 2, r"without warranties or conditions of any kind"),
    ("as-is", "provided", 2, r"(?:software|work) is provided as is"),
    ("proprietary", "proprietary", 3, r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "prohibited", 3, r"unauthori[sz]ed (?:copying|use|reproduction) .{0,60}?(?:is )?(?:strictly )?prohibited"),
    ("copyright", "copyright", 1, r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?"),
    ("reserved", "reserved", 2, r"all rights (?:are )?reserved"),
    ("reserved", "reserved", 1, r"(?:some|no) rights reserved"),
    ("permission-required", "permission", 2, r"without (?:the )?(?:prior |express )*(?:written )?permission"),
    ("noncommercial", "commercial", 2, r"for non ?commercial (?:use|purposes)(?: only)?"),
    ("no-derivatives", "derivative", 1, r"no derivative works"),
    ("copyleft", "copyleft", 1, r"copyleft"),
]
#: What a detection of each priority is worth on its own (0: a base phrase).
WORTH = {0: 0.5, 1: 0.3, 2: 0.5, 3: 0.7, 4: 0.9, 5: 0.95}


def rules() -> list[tuple[str, str, int, tuple[bytes, ...], bytes]]:
    """(label, rule, priority, keywords, expression), in order; the base phrases first, with priority 0."""
    out = [(label, f"base:{phrase}", 0, max(phrase.split(), key=len) if phrase != "cc by" else "cc", re.escape(phrase).replace(r"\ ", " ")) for phrase, label in BASE.items()]
    for label, (keywords, name) in NAMES.items():
        out += [(label, f"{label}:{form}", priority, keywords, expression.replace("N", f"(?:{name})")) for form, priority, expression in FORMS]
    out += [(label, f"{label}:clause{k}", priority, keywords, expression) for k, (label, keywords, priority, expression) in enumerate(CLAUSES)]
    return [(label, rule, priority, tuple(keywords.encode().split()), rf"(?<![^ ])(?:{expression})(?![^ ])".encode()) for label, rule, priority, keywords, expression in out]


#: A text with none of these has no detection of a FORMS rule but `see`.
GENERAL = (b"licen", b"under")
_TABLE = bytes(0x20 if NON_ALNUM[LOWER[b]] else int(LOWER[b]) for b in range(256))


class Scanner:
    def __init__(self):
        self.by_keywords: dict[tuple[bytes, ...], list] = {}
        for order, (label, rule, priority, keywords, expression) in enumerate(rules()):
            general = ":" in rule and rule.split(":")[1] in {f for f, _, _ in FORMS} - {"see"}
            self.by_keywords.setdefault(keywords, []).append((order, label, rule, priority, general, re.compile(expression, re.S)))
        self.all_keywords = sorted({k for keywords in self.by_keywords for k in keywords})

    def detections(self, flat: bytes) -> list[tuple[int, int, int, int, str, str]]:
        """(start, end, priority, order, label, rule) of all matches in the joined words."""
        found = []
        general = any(k in flat for k in GENERAL)
        for keywords, own in self.by_keywords.items():
            if any(k in flat for k in keywords):
                for order, label, rule, priority, needs_general, expression in own:
                    if general or not needs_general:
                        found += [(m.start(), m.end(), priority, order, label, rule) for m in expression.finditer(flat)]
        return found

    def hopeless(self, gaps: bytes) -> bool:
        """Whether no keyword occurs; keywords are parts of single words, so gaps don't matter."""
        return not any(k in gaps for k in self.all_keywords)


def resolve(found: list[tuple[int, int, int, int, str, str]]) -> list[tuple[int, int, int, int, str, str]]:
    """The detections that stay: base phrases, and those in no interval of a higher-ranking one. O(n log n)."""
    furthest = {p: -1 for p in WORTH}  # by priority, over the detections that start no later
    stay = []
    for d in sorted((d for d in found if d[2]), key=lambda d: (d[0], -d[1], -d[2], d[3])):
        start, end, priority = d[:3]
        if all(furthest[p] < end for p in furthest if p >= priority):
            stay.append(d)
        furthest[priority] = max(furthest[priority], end)
    return sorted([d for d in found if not d[2]] + stay)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def scan_text(text: bytes) -> tuple[int, list[tuple[int, int, int, str, str]]]:
    """(number of words, [(first word, last word, priority, label, rule)] in order) of one text."""
    s = scanner()
    gaps = text.translate(_TABLE)
    words = gaps.split()
    if s.hopeless(gaps):
        return len(words), []
    flat = b" ".join(words)
    out, at, word = [], 0, 0
    for start, end, priority, _, label, rule in resolve(s.detections(flat)):
        word += flat.count(b" ", at, start)
        at = start
        out.append((word, word + flat.count(b" ", start, end), priority, label, rule))
    return len(words), out


_DETECTION = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("priority", pa.int32()), ("label", pa.string()), ("rule", pa.string())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, detections) of every text: one scan, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                scanned = [scan_text((t or "").encode("utf-8", "replace")) for t in part.column(1).to_pylist()]
                spans = pa.array([[dict(zip(("first_word", "last_word", "priority", "label", "rule"), d)) for d in ds] for _, ds in scanned], pa.list_(_DETECTION))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array([n for n, _ in scanned], np.int64)), spans], names=[id_col, "n_words", "detections"])

    schema = f"{id_col} {kind}, n_words long, detections array<struct<first_word:long,last_word:long,priority:int,label:string,rule:string>>"
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("detections", lambda d: d["priority"] == 0)
    starts = F.transform(base, lambda d: d["first_word"])
    worth = F.create_map(*[F.lit(x) for item in WORTH.items() for x in item])

    def named(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    return scan(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named(base).alias("base_labels"),
        named(F.col("detections")).alias("labels"),
        (1 - F.aggregate("detections", F.lit(1.0), lambda acc, d: acc * (1 - worth[d["priority"]]))).alias("score"),
    )
