"""URL rules indexed by their rarest literal token.

A rule is a regular expression over host and path with the literal tokens that any match must hold as whole tokens. The
tokens of all URLs are counted for the tokens that rules name, each rule is filed under the one that the fewest URLs
hold, and the tokens of a URL fetch its candidate rules; only those run. Rules without a token always run.

Defined results: a null url, or one without ``://``, has an empty host and path; only rules that fit the empty text
fit it. Null ids and repeated rows are judged row by row. Between fitting rules the longest name wins, then the first by
name. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
TOKEN = re.compile("[0-9a-z]+")


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def place_rule(host: str, path: str, verdict: str) -> Rule:
    """A host with all its subdomains, and the beginning of a path. The last token of the path may go on in a URL."""
    tokens = TOKEN.findall(host.lower()) + TOKEN.findall(path.lower())
    if path[-1:].isalnum():
        tokens.pop()
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(tokens))


def word_rule(word: str, verdict: str) -> Rule:
    """Tokens joined by single signs, anywhere in the lower-cased host or path."""
    parts = TOKEN.findall(word)
    return Rule(word, verdict, "(?:^|[^0-9a-z])" + "[^0-9a-z]".join(parts) + "(?:$|[^0-9a-z])", tuple(parts))


#: The rules that name a place.
PLACES = tuple(
    place_rule(host, path, verdict)
    for verdict, host, path in (
        (ALLOW, "org", "/"),
        (BLOCK, "example.org", "/es/"),
        (BLOCK, "example.org", "/en/1"),
        (ALLOW, "com", "/fr/"),
        (BLOCK, "com", "/de/"),
    )
)
#: Words of unwanted hosts and paths; they judge where no place does.
UNWANTED = (
    "adult adult-x porn xxx sex escort casino free-bets bets betting poker jackpot lottery cheap-pills pills viagra cialis "
    "pharmacy replica spam spam-farm link-farm payday payday-loans loans warez crack keygen torrent malware phishing "
    "free-money get-rich clickbait adserver doubleclick banner-ads popunder"
).split()
WORDS = tuple(word_rule(w, BLOCK) for w in UNWANTED)


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substr(url, F.locate("://", url) + 3)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, lower).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def judge(pages: DataFrame, places: tuple[Rule, ...] = PLACES, words: tuple[Rule, ...] = WORDS) -> DataFrame:
    """(page_id, host, path, rule, verdict): the longest place rule that fits, else what the word rules say, else allow."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit("([0-9a-z]+)"), F.lit(1)))
    named = sorted({t for r in places + words for t in r.tokens})
    counted = split.select(F.explode(F.filter(tokens, lambda t: t.isin(named))).alias("token")).groupBy("token").count()
    seen = {r["token"]: r["count"] for r in counted.collect()}  # as many rows as rules name tokens, at most
    index: dict[str | None, list[tuple[Rule, bool]]] = {}
    for rules, is_place in ((places, True), (words, False)):
        for rule in rules:
            rarest = min(rule.tokens, key=lambda t: (seen.get(t, 0), t), default=None)
            index.setdefault(rarest, []).append((rule, is_place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r.name: re.compile(r.pattern, re.ASCII | re.DOTALL) for rules in index.values() for r, _ in rules}
        for batch in batches:
            names, verdicts = [], []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                whole, lower = host + path, (host + path).lower()
                fits: dict[bool, list[Rule]] = {True: [], False: []}
                for token in (None, *dict.fromkeys(TOKEN.findall(lower))):
                    for rule, is_place in index.get(token, ()):
                        if compiled[rule.name].search(whole if is_place else lower):
                            fits[is_place].append(rule)
                best = min(fits[True] or fits[False], key=lambda r: (-len(r.name), r.name), default=None)
                names.append(best.name if best and fits[True] else None)
                verdicts.append(best.verdict if best else ALLOW)
            rest = [batch.column(c) for c in ("page_id", "host", "path")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(names, pa.string()), pa.array(verdicts, pa.string())], ["page_id", "host", "path", "rule", "verdict"]
            )

    id_type = pages.schema["page_id"].dataType.simpleString()
    return split.mapInArrow(run, f"page_id {id_type}, host string, path string, rule string, verdict string")
