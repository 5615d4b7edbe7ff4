"""Train / test split.

Default: a hash split on the row key. The bucket is a pure function of
(MP_ID, STAT_CYCLE), so training and scoring — separate jobs that each redo
the split — always agree, whatever the file layout, partitioning or retries.
No shuffle, no sort: a projection and a filter in the scan stage.

``exact_split`` is a random split whose training side holds exactly the stated
share: the rows with the smallest seeded hashes of their key. The last hash that
trains is found by refining a histogram of hashes (a count of 65,536 bins a pass,
three passes for 100 billion rows), so nothing is sorted and the sides are the same
on any file layout.

``random_split`` keeps ``DataFrame.randomSplit`` (seed 123, 70/30) for callers that
ask for it; its rows change when the input partitioning changes, so the table is
checkpointed first and both sides are cut from the same partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import split_bucket_expr
from ..schema import KEY, SPLIT_SEED, SPLIT_WEIGHTS
from .joins import materialize

BUCKET_COL = "SPLIT_BUCKET"

#: Hex digits of a hash that one pass counts by, and those of a whole hash (60 bits,
#: as they fit a long; the key's hash, then one of the whole row).
PASS_DIGITS = 4
HASH_DIGITS = 15
#: Hashes that are few enough to be put in order on the driver.
FEW = 10_000


def hash_split(df: DataFrame, train_percent: int = 70, key=KEY) -> tuple[DataFrame, DataFrame]:
    """(train, test): rows whose key bucket is below ``train_percent`` train."""
    bucket = split_bucket_expr(*key)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def random_split(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SPLIT_SEED):
    return materialize(df).randomSplit(list(weights), seed=seed)


def split_label(df: DataFrame, train_percent: int = 70, key=KEY) -> DataFrame:
    """The key, its bucket and the side it falls on, for every row."""
    bucket = split_bucket_expr(*key)
    return df.select(*key, bucket.alias(BUCKET_COL),
                     F.when(bucket < train_percent, "train").otherwise("test").alias("SPLIT"))


def seeded_hash(seed: int, columns) -> Column:
    """60 bits of md5 of the seed and the columns, as hex digits. A null is told
    apart from every text."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns]
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, HASH_DIGITS)


def kth_smallest(rows: DataFrame, hashed: Column, k: int) -> tuple[str, int]:
    """(value, left): the ``k``-th smallest (from 1) of fixed-length hex strings, and
    how many of its occurrences are among the ``k`` smallest. Each pass counts the
    next digits of the rows under the digits known so far, at most
    ``16 ** PASS_DIGITS`` counts on the driver; ``FEW`` values are fetched at once."""
    values = rows.select(hashed.alias("h"))
    known = ""
    while True:
        step = F.substring("h", len(known) + 1, PASS_DIGITS)
        counts = values.where(F.col("h").startswith(known)).groupBy(step.alias("d")).agg(F.count(F.lit(1)).alias("n"))
        found = sorted((r.d, r.n) for r in counts.collect() if r.d)
        if not found:
            return known, k
        for digits, n in found:
            if k <= n:
                known += digits
                break
            k -= n
        else:
            raise ValueError("there are fewer values than that")
        if n <= FEW:
            rest = sorted(r.h for r in values.where(F.col("h").startswith(known)).collect())
            return rest[k - 1], k - sum(x < rest[k - 1] for x in rest)


def exact_split(df: DataFrame, share: float = 0.7, seed: int = SPLIT_SEED, key=KEY) -> tuple[DataFrame, DataFrame]:
    """(train, test): exactly ``round(share * rows)`` rows train (halves up).

    Rows go by the hash of their key, rows of one key by the hash of all their
    columns, and of rows equal in every column as many train as are due. Columns
    that ``cast`` cannot write as text (maps, arrays) may not be in ``df``.
    """
    if not 0 <= share <= 1:
        raise ValueError("a share lies between 0 and 1")
    n = df.count()
    k = int(share * n + 0.5)
    if k <= 0 or k >= n:
        none = df.limit(0)
        return (none, df) if k <= 0 else (df, none)
    of_key, of_row = seeded_hash(seed, key), seeded_hash(seed, df.columns)
    last, due = kth_smallest(df, of_key, k)
    tied = df.where(of_key == last)
    held = tied.count()
    if due == held:  # as a rule: no other row of the last key is left over
        return df.where(of_key <= last), df.where(of_key > last)
    last_row, due = kth_smallest(tied, of_row, due)
    equal = df.where((of_key == last) & (of_row == last_row))
    copies = equal.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))

    def some(times: Column) -> DataFrame:
        return copies.withColumn("__n", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select(*[F.col(f"`{c}`") for c in df.columns])

    before = (of_key < last) | ((of_key == last) & (of_row < last_row))
    behind = (of_key > last) | ((of_key == last) & (of_row > last_row))
    return df.where(before).unionAll(some(F.lit(due))), df.where(behind).unionAll(some(F.col("__n") - due))


def exact_split_label(df: DataFrame, share: float = 0.7, seed: int = SPLIT_SEED, key=KEY) -> DataFrame:
    """The key and the side of every row."""
    train, test = exact_split(df, share, seed, key)
    return train.select(*key, F.lit("train").alias("SPLIT")).unionByName(test.select(*key, F.lit("test").alias("SPLIT")))
