"""Secret scan with corpus-wide ownership frequency.

Base findings come from fixed patterns and always stay. On top of them, any long mixed token is a candidate. Candidates
are counted over the corpus by the digest of their value: in how many distinct repositories, and of how many distinct
owners, it occurs. A value that several owners share is a published example or a placeholder; a value that one owner
alone uses, in few repositories, looks live and becomes a finding of kind `owned`. The same counts label the base
findings. Only digests are shuffled, never the values.

Null texts are empty. A null repository is a repository of its own. Repeated rows are the same repository's, so they
add nothing to the counts; each row gets its result. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import map_rows, stored

# The contract's patterns, least lengths and order of kinds.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of hex digits is matched whole, so the least length can stand in the pattern
KINDS = ("assign", "access", "hex", "owned")
MIN_ASSIGN, MIN_ACCESS = 12, 18

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Candidates beyond the base: whole tokens of 20 characters or more with a digit.
MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")

SPAN = "struct<start:int,kind:int,end:int,digest:binary>"
FOUND = f"doc_id long, text_hash long, owner string, repo string, spans array<{SPAN}>"


def is_mixed(token: str) -> bool:
    """Letters and digits well mixed: at least ten different characters, with upper and lower case or with signs."""
    kinds = (any(c.islower() for c in token)) + (any(c.isupper() for c in token)) + (any(c.isdigit() for c in token))
    return kinds == 3 and len(set(token)) >= 10


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of base findings, and of candidates that no base finding touches."""
    spans = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        spans += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    taken = [(s, e) for s, _, e, _ in spans]
    for m in MIXED.finditer(text):
        if is_mixed(m[0]) and not any(s < m.end() and m.start() < e for s, e in taken):
            spans.append((m.start(), 3, m.end(), m[0]))
    return sorted(spans)


def find_spans(rows):
    for doc_id, text_hash, text, owner, repo in rows:
        spans = [{"start": s, "kind": k, "end": e, "digest": hashlib.sha256(v.encode()).digest()[:16]} for s, k, e, v in scan(text or "")]
        yield doc_id, text_hash, owner, repo, spans


def listed(spans: Column) -> Column:
    """`kind:start:end` of spans that are ordered by start and kind, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))


def find_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repo: str = "source",
    owner: Column | None = None,
    max_owners: int = 1,
    max_repos: int = 3,
) -> DataFrame:
    """Per row: doc_id, base (spans), spans (all), n_live and n_example (findings by their values' ownership).

    `owner` defaults to what stands before the first slash of the repository's name.
    """
    own = owner if owner is not None else F.substring_index(repo, "/", 1)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"),
        F.coalesce(own, F.lit("")).alias("owner"), F.coalesce(F.col(repo), F.lit("")).alias("repo"),
    )
    found = stored(map_rows(rows, find_spans, FOUND), "secret-spans")

    # one row per value and repository leaves a task, however often it occurs
    uses = found.select("owner", "repo", F.explode("spans.digest").alias("digest")).distinct()
    owners = uses.groupBy("digest").agg(F.count_distinct("owner").alias("n_owners"), F.count_distinct("owner", "repo").alias("n_repos"))

    spans = found.select("doc_id", "text_hash", F.explode("spans").alias("span")).distinct()
    judged = spans.join(owners, F.col("span.digest") == F.col("digest")).select(
        "doc_id", "text_hash", "span", ((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)).alias("live")
    )
    per_doc = judged.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.when((F.col("span.kind") < 3) | F.col("live"), F.col("span")))).alias("spans"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
    ).withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    every = found.select("doc_id", "text_hash")
    joined = every.join(per_doc, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("h")), "left")
    none = F.array().cast(f"array<{SPAN}>")
    return joined.select(
        "doc_id",
        F.coalesce(F.filter("spans", lambda s: s["kind"] < 3), none).alias("base"),
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )
