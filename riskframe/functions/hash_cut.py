"""Exact cuts in a seeded hash order, without sorting or moving rows.

A split, a fold or a subsample of exact size is "the first r rows of each class in hash
order".  ``hash_cuts`` finds, for any number of ranks per class, the hash below which exactly
r rows lie: rows are counted by the first ``DIGITS`` digits of their hash, then only those in
the prefixes that a cut falls into by the next digits, until each cut lies between two
prefixes.  Each pass is one count with partial sums; at most classes x 16**DIGITS counts come
to the driver in the first one, and ranks x 16**DIGITS in each later one, whatever the rows.
The wide rows are then compared with their class's bound where they are.

The order is the md5 of ``key:seed`` in hexadecimal, which any SQL engine repeats.  Rows of
equal key have one hash and lie on one side of a cut, so that a repeated key may move a cut by
its copies; null keys count as the empty key, a null class is a class of its own.
"""
from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reuse

DIGITS = 3
HEX_DIGITS = 32
#: Above every hexadecimal digit, so that ``p + LAST`` bounds all hashes that start with ``p``.
LAST = "g"


def hash_order(key: str, seed: int) -> Column:
    """md5 of ``key:seed``, 32 hexadecimal digits."""
    return F.md5(F.concat(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.lit(f":{seed}")))


def hash_cuts(df: DataFrame, key: str, seed: int, by: str,
              ranks: Callable[[list[tuple]], dict]) -> dict:
    """{class: [bound, ...]}: of a class, as many rows as its rank have a hash < bound.

    ``ranks`` gets the sorted [(class, rows)] and gives {class: [rank, ...]}; a rank of 0 or
    less takes no row, one beyond the class's rows takes all.
    """
    base = df.select(F.col(f"`{by}`").alias("c"), hash_order(key, seed).alias("h"))
    # two narrow columns, read once a pass; the text makes the persisted frame this call's own,
    # as fits run in threads and may cut the same rows at once
    held = reuse(base.where(F.lit(uuid.uuid4().hex).isNotNull()))
    wanted, open_, found, depth = None, {}, {}, 0
    while wanted is None or open_:
        before, depth = depth, min(depth + DIGITS, HEX_DIGITS)
        rows = held
        if wanted is not None:
            rows = rows.where(F.substring("h", 1, before).isin(sorted({p for p, _ in open_.values()})))
        counts = defaultdict(list)
        for r in rows.groupBy("c", F.substring("h", 1, depth).alias("p")).count().collect():
            counts[r["c"]].append((r["p"], r["count"]))
        if wanted is None:
            sizes = sorted(((c, sum(n for _, n in v)) for c, v in counts.items()), key=lambda t: (t[0] is None, t[0]))
            wanted = ranks(sizes)
            for c, n in sizes:
                for r in wanted[c]:
                    if 0 < r < n:
                        open_[c, r] = ("", r)
                    else:
                        found[c, r] = "" if r <= 0 else LAST
        for (c, r), (prefix, left) in list(open_.items()):
            for p, n in sorted(x for x in counts[c] if x[0].startswith(prefix)):
                if n >= left:
                    break
                left -= n
            if n == left or depth == HEX_DIGITS:
                found[c, r] = p + LAST
                del open_[c, r]
            else:
                open_[c, r] = (p, left)
    held.unpersist()
    return {c: [found[c, r] for r in rs] for c, rs in wanted.items()}
