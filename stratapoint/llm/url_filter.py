"""URL filters: host and path rules first, then a weighted vocabulary matched by one Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One strict term, or SOFT_LIMIT distinct soft terms, rejects a url.
STRICT = ("adult", "bets", "casino", "escort", "gambling", "hentai", "malware", "nude", "phishing", "pills", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "banner", "bonus", "cheap", "click", "coupon", "crack", "dating", "discount", "farm", "free", "jackpot", "loan", "lottery", "popup", "promo", "track", "tracker", "win", "winner")
SOFT_LIMIT = 2

Rule = tuple[str, str, str]  # verdict, host, path
RULES: tuple[Rule, ...] = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
OUT = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("strict_hits", pa.int32()), ("soft_hits", pa.int32())])


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without '://'."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host_end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path_end = min((i for i in (rest.find(c, host_end) for c in "?#") if i >= 0), default=len(rest))
    host = rest[:host_end].encode().translate(_LOWER).decode()
    return host, rest[host_end:path_end]


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def best_rule(host: str, path: str, rules: Sequence[Rule]) -> Rule | None:
    """The longest rule (host and path together) that fits."""
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: len(r[1]) + len(r[2]), default=None)


@lru_cache(maxsize=4)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term in soft:
        machine.add_word(term, (term, 0))
    for term in strict:
        machine.add_word(term, (term, 1))
    machine.make_automaton()
    return machine


def vocabulary_hits(url: str | None, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT) -> tuple[int, int]:
    """Distinct strict and soft terms of the lower-cased url that no letter or digit touches on either side."""
    low = (url or "").lower()
    found: set[tuple[str, int]] = set()
    for end, (term, kind) in _automaton(strict, soft).iter(low):
        start = end - len(term) + 1
        if not (start and low[start - 1].isalnum()) and not (end + 1 < len(low) and low[end + 1].isalnum()):
            found.add((term, kind))
    n_strict = sum(kind for _, kind in found)
    return n_strict, len(found) - n_strict


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[Rule] = RULES, strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, strict_hits, soft_hits.

    A null url counts as empty: it has no host, fits no rule and is allowed. Rows are judged one by one, so repeated
    rows repeat; only the two columns are read. One pass over the table, no shuffle.
    """
    strict, soft, rules = tuple(strict), tuple(soft), tuple(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                n_strict, n_soft = vocabulary_hits(url, strict, soft)
                rule = best_rule(host, path, rules)
                verdict = rule[0] if rule else "block" if n_strict or n_soft >= soft_limit else "allow"
                out.append((host, path, rule[1] + rule[2] if rule else None, verdict, n_strict, n_soft))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(OUT)[1:], strict=True))], schema=OUT)

    ids = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    return ids.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_hits int")
