"""Secrets in texts, with the owners of every candidate counted over the whole corpus.

Three base patterns always count. Further candidates, assignments to other names
and opaque tokens, count if their value is specific: what many owners or
repositories hold is an example that was copied, what one or two hold looks live.
Only hashes of values are shuffled and stored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from areapulse.llm.common import map_rows
from areapulse.session import stage


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def assignment(names: list[str]) -> str:
    """A value that is assigned to one of ``names``; an underscore in a name may be missing."""
    words = "|".join(either_case(n).replace("_", "_?") for n in names)
    return rf"(?:{words})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"


# Names, prefix, alphabets and least lengths of the base kinds. A run that is
# asked for with its least length is the same maximal run, found without trying shorter ones.
BASE_NAMES = ["password", "passwd", "secret", "token", "api_key"]
BASE = [
    ("assign", assignment(BASE_NAMES), 12),
    ("access", r"(AKIA[A-Z0-9]{14,})", 18),
    ("hex", r"([0-9a-f]{16,})", 16),
]
MORE_NAMES = ["pwd", "bearer", "credential", "private_key", "access_key", "auth_key", "client_key"]
MORE = [
    ("keyed", assignment(MORE_NAMES), 12),
    ("opaque", r"([A-Za-z0-9+/_-]{24,})", 24),
]
KINDS = [name for name, _, _ in BASE + MORE]
#: An added candidate has a digit, both cases, and so many different characters.
VARIED = 12
#: Beyond so many owners, or repositories, a value is a copied example.
MOST_OWNERS = 2
MOST_REPOSITORIES = 4
#: Rows of one value, which a third of all documents may hold, are dealt to so many tasks.
SALTS = 16

SPAN = "array<struct<at:long,kind:int,until:long,base:boolean,hash:binary>>"
_COMPILED = [(re.compile(pattern), least) for _, pattern, least in BASE + MORE]
#: Kinds that only need to be looked for where one of these names occurs.
_NAMED = {0: [n.replace("_", "") for n in BASE_NAMES] + BASE_NAMES, 3: [n.replace("_", "") for n in MORE_NAMES] + MORE_NAMES}
_MIXED = [re.compile(p) for p in ("[0-9]", "[a-z]", "[A-Z]")]


def varied(value: str) -> bool:
    return len(set(value)) >= VARIED and all(p.search(value) for p in _MIXED)


def candidates(text: str) -> list[tuple[int, int, int, bool, str]]:
    """(start, kind, end, base, value) of all matches that are long enough; added ones are varied and touch no base match."""
    out: list[tuple[int, int, int, bool, str]] = []
    taken: list[tuple[int, int]] = []
    lower = text.lower()
    for kind, (pattern, least) in enumerate(_COMPILED):
        base = kind < len(BASE)
        if kind == len(BASE):
            taken = merged(sorted((s, e) for s, _, e, _, _ in out))
        if kind in _NAMED and not any(name in lower for name in _NAMED[kind]):
            continue
        for match in pattern.finditer(text):
            value = match.group(1)
            if len(value) >= least and (base or varied(value) and not overlaps(taken, *match.span())):
                out.append((match.start(), kind, match.end(), base, value))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that overlap joined."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def overlaps(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the sorted, disjoint spans shares a character with start to end."""
    from bisect import bisect_left

    at = bisect_left(spans, (end,)) - 1
    return at >= 0 and spans[at][1] > start


def found(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """A stored row per document: ``row``, ``doc_id``, ``repository``, ``owner``, and ``spans`` with hashes of their values."""
    picked = docs.select("doc_id", "text", repository.cast("string").alias("repository"), owner.cast("string").alias("owner"))

    def each(doc_id, text, repository, owner) -> Iterator[tuple]:
        spans = [
            {"at": start, "kind": kind, "until": end, "base": base, "hash": hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()}
            for start, kind, end, base, value in candidates(text or "")
        ]
        yield doc_id, repository, owner, spans

    schema = f"doc_id long, repository string, owner string, spans {SPAN}"
    rows = map_rows(picked, picked.columns, schema, each, weight=lambda r: 64 * len(r[3]))
    return stage(docs.sparkSession, rows.withColumn("row", F.monotonically_increasing_id()), "secret_spans")


def ownership(rows: DataFrame) -> DataFrame:
    """``hash``, ``owners`` and ``repositories`` of every candidate value; NULL is an owner and a repository of its own."""
    held = rows.select("repository", "owner", F.explode("spans.hash").alias("hash")).distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, separated by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", names[s["kind"]], s["at"], s["until"])
    return F.array_join(F.transform(F.array_sort(spans), text), ",")


def scanned(
    docs: DataFrame, repository: Column, owner: Column, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """Secrets of every row: counts of the base kinds, ``base_sha256``, and ``spans`` with the specific further ones.

    ``n_live`` counts spans whose value at most ``most_owners`` owners and
    ``most_repositories`` repositories hold, ``n_copied`` the base spans of other
    values. Places are code points, ends exclusive. A NULL text is empty; rows
    that repeat an id, or have none, are scanned and returned one by one, but a
    value counts once for an owner and a repository, however often they hold it.
    An empty table gives no rows. Texts are scanned whole, one at a time. Other
    columns of ``docs`` are not read.
    """
    rows = found(docs, repository, owner)
    census = stage(docs.sparkSession, ownership(rows), "secret_owners")
    specific = census.where((F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)).select(
        "hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salt = F.pmod(F.col("row"), F.lit(SALTS)).cast("int").alias("salt")
    spread = rows.select("row", salt, F.inline("spans"))
    live = (
        spread.join(specific, ["hash", "salt"])
        .groupBy("row")
        .agg(
            F.count("*").alias("n_live"), F.count_if("base").alias("_base_live"),
            F.collect_list(F.when(~F.col("base"), F.struct("at", "kind", "until"))).alias("_added"),
        )
    )
    base = F.transform(F.filter("spans", lambda s: s["base"]), lambda s: F.struct(s["at"].alias("at"), s["kind"].alias("kind"), s["until"].alias("until")))
    of = F.transform("_base", lambda s: s["kind"])
    counted = {f"n_{name}": (F.size(of) - F.size(F.array_remove(of, i))).cast("long") for i, (name, _, _) in enumerate(BASE)}
    every = F.concat("_base", F.coalesce("_added", F.slice("_base", 1, 0)))
    return (
        rows.withColumn("_base", base)
        .join(live, "row", "left")
        .select(
            "doc_id", *[c.alias(n) for n, c in counted.items()],
            F.sha2(joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"), joined(every).alias("spans"),
            F.coalesce("n_live", F.lit(0)).alias("n_live"),
            (F.size("_base") - F.coalesce("_base_live", F.lit(0))).cast("long").alias("n_copied"),
        )
    )
