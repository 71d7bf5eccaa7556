"""License detections by ordered signature rules.

A rule is a regular expression with a label, a priority, a confidence and keywords that any match holds. Only texts
with all keywords run the expression. Of overlapping detections, one that lies inside another of higher priority, or of
the same priority and longer, is dropped. Phrases, words that stand consecutively, are rules whose every place counts:
their labels stay whatever lies around them.

Words are runs of digits, letters (A-Z in lower case) and bytes from 0x80. Defined results: null and empty texts, and
texts without words, have no detections and score 0; null ids and repeated rows are scanned each; extra columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.hashing import LOWER, Words
from hemicycle.llm.storage import slices, text_bytes

_codes = np.arange(256)
GAP = ~(((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= ord("a")) & (_codes <= ord("z"))) | (_codes >= 0x80))
LETTER, BETWEEN = r"[0-9a-z\x80-\xff]", r"[^0-9a-z\x80-\xff]+"

#: Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Licenses by label: names as they stand in texts, divided by semicolons (~ is a gap or
#: a hyphen), and version numbers that may follow.
LICENSES = {
    "agpl": ("gnu affero general public licen[cs]e;agpl", "3|3.0"),
    "lgpl": ("gnu (?:lesser|library) general public licen[cs]e;lgpl", "2|2.0|2.1|3|3.0"),
    "gpl": ("gnu general public licen[cs]e;gnu gpl;gpl", "1|2|2.0|3|3.0"),
    "gfdl": ("gnu free documentation licen[cs]e;gfdl", "1.1|1.2|1.3"),
    "apache": ("apache licen[cs]e;apache software licen[cs]e;apache", "1.0|1.1|2|2.0"),
    "mit": ("mit licen[cs]e;mit/x11 licen[cs]e;expat licen[cs]e;mit", ""),
    "bsd-2-clause": ("(?:simplified|freebsd|two-clause|2-clause) bsd licen[cs]e;bsd 2-clause;bsd-2-clause", ""),
    "bsd-3-clause": ("(?:new|modified|revised|three-clause|3-clause) bsd licen[cs]e;bsd 3-clause;bsd-3-clause", ""),
    "bsd-4-clause": ("(?:original|four-clause|4-clause) bsd licen[cs]e;bsd-4-clause", ""),
    "bsd": ("bsd licen[cs]e;bsd-style licen[cs]e;bsd", ""),
    "mpl": ("mozilla public licen[cs]e;mpl", "1.0|1.1|2|2.0"),
    "epl": ("eclipse public licen[cs]e;epl", "1.0|2.0"),
    "cddl": ("common development and distribution licen[cs]e;cddl", "1.0|1.1"),
    "cpl": ("common public licen[cs]e;cpl", "0.5|1.0"),
    "ipl": ("ibm public licen[cs]e", "1.0"),
    "eupl": ("european union public licen[cs]e;eupl", "1.0|1.1|1.2"),
    "isc": ("isc licen[cs]e;isc", ""),
    "zlib": ("zlib licen[cs]e;zlib/libpng licen[cs]e;zlib", ""),
    "unlicense": ("the unlicen[cs]e;unlicense", ""),
    "wtfpl": ("wtfpl;do what the f[a-z*]+ you want to public licen[cs]e", "2"),
    "boost": ("boost software licen[cs]e;bsl-1.0", "1.0"),
    "artistic": ("artistic licen[cs]e;artistic", "1.0|2.0"),
    "perl": ("same terms as perl itself", ""),
    "python": ("python software foundation licen[cs]e;psf licen[cs]e", "2|2.0"),
    "php": ("php licen[cs]e", "3.0|3.01"),
    "ruby": ("ruby licen[cs]e", ""),
    "postgresql": ("postgresql licen[cs]e", ""),
    "openssl": ("openssl licen[cs]e", ""),
    "ofl": ("sil open font licen[cs]e;open font licen[cs]e;ofl", "1.0|1.1"),
    "ncsa": ("university of illinois/ncsa open source licen[cs]e;ncsa", ""),
    "odbl": ("open database licen[cs]e;odbl", "1.0"),
    "odc-by": ("open data commons attribution licen[cs]e;odc-by", "1.0"),
    "pddl": ("public domain dedication and licen[cs]e;pddl", "1.0"),
    "cc0": ("creative commons zero;cc0;cc zero", "1.0"),
    "cc-by-nc-sa": ("creative commons attribution-noncommercial-sharealike;cc~by~nc~sa", "1.0|2.0|2.5|3.0|4.0"),
    "cc-by-nc-nd": ("creative commons attribution-noncommercial-noderiv[a-z]*;cc~by~nc~nd", "1.0|2.0|2.5|3.0|4.0"),
    "cc-by-nc": ("creative commons attribution-noncommercial;cc~by~nc", "1.0|2.0|2.5|3.0|4.0"),
    "cc-by-sa": ("creative commons attribution-sharealike;cc~by~sa", "1.0|2.0|2.5|3.0|4.0"),
    "cc-by-nd": ("creative commons attribution-noderiv[a-z]*;cc~by~nd", "1.0|2.0|2.5|3.0|4.0"),
    "cc-by": ("creative commons attribution;cc~by", "1.0|2.0|2.5|3.0|4.0"),
}
#: Ways in which a text names its license: priority, confidence, expression around a name, whether short names do, and
#: what the expression holds besides the name.
FORMS = (
    (90, 0.99, r"spdx-license-identifier: ?(?:NAME)(?:-[\w.+-]+)?", True, "spdx-licen"),
    (80, 0.97, r"licen[cs]ed under (?:the )?(?:terms of )?(?:the )?(?:NAME)(?:VERSION)?", True, "licen under"),
    (80, 0.97, r"(?:released|distributed|available|published|provided|covered) under (?:the )?(?:terms of )?(?:the )?(?:NAME)(?:VERSION)?", True, "under"),
    (70, 0.95, r"under the (?:terms|conditions) of (?:the )?(?:NAME)(?:VERSION)?", True, "under"),
    (70, 0.9, r"licen[cs]e: ?(?:the )?(?:NAME)(?:VERSION)?", True, "licen"),
    (60, 0.9, r"copy of the (?:NAME)(?:VERSION)?", False, "copy"),
    (50, 0.8, r"(?:NAME)VERSION", True, ""),
    (40, 0.7, r"(?:NAME)", False, ""),
)
#: Statements that name no license: label, priority, confidence, single words that any match holds, expression.
STATEMENTS = (
    ("all-rights-reserved", 30, 0.6, "rights reserved", r"all rights reserved"),
    ("copyright", 20, 0.5, "copyright", r"copyright (?:\(c\) )?(?:\d{4}|by )"),
    ("public-domain", 30, 0.6, "public domain", r"(?:in|into|to) the public domain"),
    ("no-warranty", 20, 0.5, "warrant", r"without (?:any )?warrant(?:y|ies)"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keywords: tuple[bytes, ...]
    pattern: bytes


def whole(pattern: str) -> bytes:
    """An expression that neither starts nor ends within a word; a space stands for white space, ~ and ^ for more gaps."""
    pattern = pattern.replace(" ?", r"[\x00-\x20]*").replace(" ", r"[\x00-\x20]+").replace("~", r"[\x00-\x20/-]+").replace("^", r"[\x00-\x20,-]+")
    return rf"(?<!{LETTER})(?:{pattern})(?!{LETTER})".encode("latin-1")


def literals(name: str) -> tuple[bytes, ...]:
    """The literal words of an expression for a name; any match holds them all."""
    plain = re.sub(r"\(.*?\)|[a-z]\[.*?\][*+]?|[a-z]?\[a-z\]", " ", name)
    return tuple(dict.fromkeys(p.encode() for p in re.split(r"[ ~()|]+", plain) if len(p) > 1))


def rules() -> tuple[Rule, ...]:
    """Signature rules by falling priority: each form of each license by each of its names, and the statements."""
    found = [Rule(label, p, c, tuple(k.encode().split()), whole(x)) for label, p, c, k, x in STATEMENTS]
    for label, (names, versions) in LICENSES.items():
        numbers = "|".join(re.escape(v) for v in sorted(filter(None, versions.split("|")), key=len, reverse=True))
        version = rf"^(?:version |v\.? ?|ver\. )?(?:{numbers})" if numbers else ""
        for name in names.split(";"):
            short = "licen" not in name and " " not in name
            for priority, confidence, form, for_short, beside in FORMS:
                if (short and not for_short) or ("VERSION" in form and not form.endswith("?") and not version):
                    continue
                text = form.replace("(?:VERSION)?", f"(?:{version})?" if version else "").replace("VERSION", version).replace("NAME", name)
                held = literals(name) + ((b"licen",) if "licen" in name else ()) + tuple(beside.encode().split())
                found.append(Rule(label, priority, confidence, held, whole(text)))
    return tuple(sorted(found, key=lambda r: -r.priority))


def phrases() -> tuple[tuple[str, bytes, bytes], ...]:
    """Label, keyword and expression of each phrase; the expression finds every place."""
    out = []
    for words, label in PHRASES:
        parts = words.split()
        expression = rf"(?<!{LETTER}){parts[0]}(?={BETWEEN}{BETWEEN.join(parts[1:])}(?!{LETTER}))"
        out.append((label, max(parts, key=len).encode(), expression.encode("latin-1")))
    return tuple(out)


def surviving(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections that lie in no other of higher priority, or of the same and longer; of equal ones the first by label."""
    order = sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
    starts = sorted({d[0] for d in found})
    furthest = [-1] * (len(starts) + 1)  # a tree of the largest ends, by start; containment asks for one prefix
    kept: list[tuple[int, int, Rule]] = []
    for start, end, rule in order:
        at = place = bisect_left(starts, start) + 1
        reach = -1
        while at:
            reach, at = max(reach, furthest[at]), at & (at - 1)
        if reach < end:
            kept.append((start, end, rule))
            while place <= len(starts):
                furthest[place], place = max(furthest[place], end), place + (place & -place)
    return kept


class Scanner:
    """The rules, and expressions compiled when a text first passes their keywords."""

    def __init__(self):
        self.rules, self.phrases = rules(), phrases()
        self.compiled: dict[bytes, re.Pattern[bytes]] = {}
        every = {max(r.keywords, key=len) for r in self.rules} | {k for _, k, _ in self.phrases}
        #: every text with a phrase or a detection holds one of these
        self.gates = tuple(k for k in sorted(every, key=len) if not any(o != k and o in k for o in every))

    def places(self, pattern: bytes, text: bytes) -> Iterator[re.Match[bytes]]:
        if pattern not in self.compiled:
            self.compiled[pattern] = re.compile(pattern)
        return self.compiled[pattern].finditer(text)

    def __call__(self, text: bytes) -> tuple[list[tuple[int, str]], list[tuple[int, int, Rule]]]:
        """Places of phrases (start, label), and surviving detections, of a lower-case text."""
        base = [(m.start(), label) for label, keyword, pattern in self.phrases if keyword in text for m in self.places(pattern, text)]
        held: dict[bytes, bool] = {}
        found = []
        for rule in self.rules:
            for keyword in rule.keywords:
                if keyword not in held:
                    held[keyword] = keyword in text
                if not held[keyword]:
                    break
            else:
                found += [(*m.span(), rule) for m in self.places(rule.pattern, text)]
        return base, surviving(found)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) for every row.

    ``detections`` are the surviving ones: label, priority, and the bytes from start to end. The score is the chance
    that at least one holds, by their confidences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for table in slices(batches):
            data, offsets = text_bytes(table.column("text"))
            data = LOWER[data]
            words = Words(data, offsets, GAP)
            whole_text = data.tobytes()
            open_ = np.zeros(table.num_rows, bool)
            for gate in scanner.gates:
                at = whole_text.find(gate)
                while at >= 0:
                    row = int(np.searchsorted(offsets, at, "right")) - 1
                    open_[row] = True
                    at = whole_text.find(gate, int(offsets[row + 1]))
            n = table.num_rows
            base_n, first, last = np.zeros(n, np.int64), [None] * n, [None] * n
            base_labels, labels, scores, detections = [""] * n, [""] * n, np.zeros(n), [[]] * n
            for i in np.flatnonzero(open_).tolist():
                base, found = scanner(whole_text[offsets[i] : offsets[i + 1]])
                own = {label for _, label in base}
                if base:
                    begin = words.start[words.bounds[i] : words.bounds[i + 1]] - offsets[i]
                    at = np.searchsorted(begin, [s for s, _ in base])
                    base_n[i], first[i], last[i] = len(base), int(at.min()), int(at.max())
                base_labels[i] = ",".join(sorted(own))
                labels[i] = ",".join(sorted(own | {r.label for *_, r in found}))
                doubt = 0.05 if base else 1.0
                for *_, rule in found:
                    doubt *= 1 - rule.confidence
                scores[i] = 1 - doubt
                detections[i] = [{"label": r.label, "priority": r.priority, "start": a, "end": b} for a, b, r in sorted(found, key=lambda d: d[:2])]
            kind = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks(), pa.array(words.counts, pa.int64()), pa.array(base_n), pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()), pa.array(base_labels), pa.array(labels), pa.array(scores), pa.array(detections, kind),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "detections array<struct<label: string, priority: int, start: long, end: long>>",
    )
