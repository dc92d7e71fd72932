"""Sampling, splitting, undersampling and set difference.

Random choices come from ``playlab.functions.hashing``: a row's fate is a
function of its key, so a sample and its remainder are exact complements
computed by two filters (no join), the result does not depend on the
partition layout, and a lost executor recomputes the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlab.functions.columns import KEY, LABEL, SAMPLE_FRACTIONS
from playlab.functions.hashing import HASH_RANGE, row_hash, uniform_hash
from playlab.session import materialize

# Up to this many classes, per-class values are inlined as literal maps;
# beyond, they stay a table joined on the label.
MAX_INLINE_CLASSES = 10_000


def _hash(df: DataFrame, key, purpose: str, seed: int) -> Column:
    """Hash of the key (a column name or a list of names) or of the whole row."""
    if not key:
        return row_hash(df.columns, purpose, seed)
    if isinstance(key, (list, tuple)):
        return uniform_hash(key[0], purpose, seed, *key[1:])
    return uniform_hash(key, purpose, seed)


def _fraction_of(label: str, fractions: dict) -> Column:
    """fractions[label] as a column; labels not in the map get 0."""
    items = []
    for k, v in sorted(fractions.items()):
        items += [F.lit(k), F.lit(float(v))]
    return F.coalesce(F.create_map(*items)[F.col(label)], F.lit(0.0))


@dataclass(frozen=True)
class StratifiedSplit:
    """Bernoulli sample per label with fixed fractions.

    A row is in the sample when hash(key, 'sample', seed) < fraction * 2**32.
    A label missing from ``fractions`` (or NULL) has fraction 0: never in the
    sample, always in the remainder.
    """

    label: str = LABEL
    fractions: dict = field(default_factory=lambda: dict(SAMPLE_FRACTIONS))
    seed: int = 42
    key: str | None = KEY

    def in_sample(self, df: DataFrame) -> Column:
        h = _hash(df, self.key, "sample", self.seed)
        return h < _fraction_of(self.label, self.fractions) * F.lit(float(HASH_RANGE))

    def sample(self, df: DataFrame) -> DataFrame:
        return df.where(self.in_sample(df))

    def remainder(self, df: DataFrame) -> DataFrame:
        """Every row not in the sample, duplicates kept; a filter, not a join."""
        return df.where(~self.in_sample(df))


def sample_by(df: DataFrame, label: str = LABEL, fractions: dict | None = None, seed: int = 42,
              key: str | None = KEY, method: str = "hash") -> DataFrame:
    """Stratified Bernoulli sample (R1); ``method="native"`` uses ``DataFrame.sampleBy``.

    The native sampler draws per partition, so its rows change with the
    partition layout; the hash sampler does not.
    """
    fractions = dict(SAMPLE_FRACTIONS if fractions is None else fractions)
    if method == "native":
        return df.sampleBy(label, fractions=fractions, seed=seed)
    return StratifiedSplit(label, fractions, seed, key).sample(df)


def remainder(df: DataFrame, sample: DataFrame, key: str | None = None) -> DataFrame:
    """Rows of ``df`` not in ``sample``.

    Without a key this is EXCEPT DISTINCT (R2): duplicates collapse, NaN
    equals NaN and NULL equals NULL; Catalyst plans a null-safe left-anti join
    plus an aggregate, shuffling on all columns.  With a key it is a left-anti
    join on the key (R2b), which keeps duplicates and shuffles only the key.
    """
    if key is None:
        return df.subtract(sample)
    return df.join(sample.select(key), on=key, how="left_anti")


def season_split(df: DataFrame, season: int, column: str = "season", drop: bool = True):
    """Train on seasons before ``season``, test on ``season``."""
    train = df.where(F.col(column) < season)
    test = df.where(F.col(column) == season)
    if drop:
        train, test = train.drop(column), test.drop(column)
    return train, test


def in_split(df: DataFrame, ratio: float = 0.8, seed: int = 42, key: str | None = KEY):
    """Whether a row is in the first part of ``tv_split``."""
    return _hash(df, key, "split", seed) < F.lit(ratio * HASH_RANGE)


def tv_split(df: DataFrame, ratio: float = 0.8, seed: int = 42, key: str | None = KEY):
    """Random train/validation split by key hash (R5): exact complements."""
    inside = in_split(df, ratio, seed, key)
    return df.where(inside), df.where(~inside)


def undersample_targets(counts: dict, rounds: int = 1) -> dict:
    """Class sizes after ``rounds`` of 'cut the majority class to the minority size'.

    A tie for the largest class goes to the alphabetically first label.
    """
    cur = dict(counts)
    for _ in range(rounds):
        if not cur:
            break
        n_min = min(cur.values())
        majority = sorted(cur.items(), key=lambda kv: (-kv[1], str(kv[0])))[0][0]
        cur[majority] = n_min
    return cur


def _literal_map(d: dict):
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def _boundary(hist: DataFrame, label: str) -> DataFrame:
    """Per class the bin ``_e`` where the running count of (label, _bin, _n) reaches ``_w``, how many rows are still
    wanted there (``_k``) and how many it holds (``_in``); classes that never reach it are left out."""
    w_cum = Window.partitionBy(label).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (hist.withColumn("_cum", F.sum("_n").over(w_cum))
            .where((F.col("_cum") - F.col("_n") < F.col("_w")) & (F.col("_cum") >= F.col("_w")))
            .select(label, F.col("_bin").alias("_e"), (F.col("_w") - (F.col("_cum") - F.col("_n"))).alias("_k"),
                    F.col("_n").alias("_in")))


def mark_smallest(df: DataFrame, label: str, key: str | None, purpose: str, seed: int, want,
                  flag: str = "_sel", bits: int = 16, most: int = 1_000_000, diagnostics: dict | None = None) -> DataFrame:
    """Add a boolean ``flag``: true for the ``want[c]`` rows of class c with the
    smallest (hash(key, purpose, seed), key); all rows when ``want[c]`` is at
    least the class size; false for classes not in ``want``.

    ``want`` is a dict, or a function from the class counts to that dict; the
    counts then come from the same histogram pass (cached: it has at most
    classes * 2**bits rows), so the data is read once for the statistics.

    No class is sorted in one task.  A histogram of the top ``bits`` bits of
    the hash per (class, bin) -- a map-side combined aggregate -- gives, per
    class, the bin where the running count reaches the target.  While some
    boundary bin holds more than ``most`` rows, a histogram of 8 more bits of the
    rows inside the boundary bins refines it (radix selection; the hash has 32 bits).  Rows in lower
    bins are flagged by a filter, rows in higher bins are not, and only the
    boundary bin (at most ``most`` rows, or the rows of one hash value) is ranked by a window.
    Without a key, identical rows share one hash; in the boundary bin they
    are collapsed map-side and only distinct rows are ranked, each keeping
    as many copies as still fit, so a huge group of copies costs one row.
    """
    base = (df.withColumn("_h", _hash(df, key, purpose, seed))
              .withColumn("_bin", F.shiftright("_h", 32 - bits)))
    cached = None
    if callable(want):
        cached = (base.where(F.col(label).isNotNull()).groupBy(label, "_bin")
                      .agg(F.count(F.lit(1)).alias("_n"))
                      .persist(StorageLevel.MEMORY_AND_DISK))
        counts = {r[label]: int(r["n"]) for r in cached.groupBy(label).agg(F.sum("_n").alias("n")).collect()}
        want = want(counts)
    live = {c: int(n) for c, n in want.items() if n > 0 and c is not None}
    if not live:
        if cached is not None:
            cached.unpersist()
        return df.withColumn(flag, F.lit(False))
    lab = F.col(label)
    inline = len(live) <= MAX_INLINE_CLASSES
    if inline:  # per-class values as literal maps inside the plan
        want_map = _literal_map(live)
        hist = cached if cached is not None else (
            base.where(want_map[lab].isNotNull()).groupBy(label, "_bin").agg(F.count(F.lit(1)).alias("_n")))
        hist = hist.withColumn("_w", want_map[lab]).where(F.col("_w").isNotNull())
    else:  # many classes: per-class values stay a table, joined on the label
        targets = df.sparkSession.createDataFrame(
            list(live.items()), T.StructType([df.schema[label], T.StructField("_w", T.LongType())]))
        hist = cached if cached is not None else (
            base.join(targets.select(label), label).groupBy(label, "_bin").agg(F.count(F.lit(1)).alias("_n")))
        hist = hist.join(targets, label)
    at_bits = lambda b: F.shiftright("_h", 32 - b)
    bounds = _boundary(hist, label)
    if inline:
        rows = bounds.collect()  # at most one row per class in `want`
        while bits < 32 and any(r["_in"] > most for r in rows):
            edge, left = (_literal_map({r[label]: r[c] for r in rows})[lab] for c in ("_e", "_k"))
            finer = min(bits + 8, 32)
            hist = (base.where(at_bits(bits) == edge).groupBy(label, at_bits(finer).alias("_bin"))
                    .agg(F.count(F.lit(1)).alias("_n")).withColumn("_w", left))
            rows, bits = _boundary(hist, label).collect(), finer
        held = max((r["_in"] for r in rows), default=0)
        marked = base.withColumn("_bin", at_bits(bits)).withColumn("_w", want_map[lab])
        if rows:
            marked = (marked.withColumn("_e", _literal_map({r[label]: r["_e"] for r in rows})[lab])
                            .withColumn("_k", _literal_map({r[label]: r["_k"] for r in rows})[lab]))
        else:
            marked = marked.withColumn("_e", F.lit(None).cast("bigint")).withColumn("_k", F.lit(None).cast("bigint"))
    else:
        bounds = materialize(bounds)  # one row per class, written once
        held = bounds.agg(F.max("_in")).first()[0] or 0
        while bits < 32 and held > most:
            finer = min(bits + 8, 32)
            hist = (base.join(bounds.drop("_in"), label).where(at_bits(bits) == F.col("_e"))
                    .groupBy(label, at_bits(finer).alias("_bin"), F.col("_k").alias("_w")).agg(F.count(F.lit(1)).alias("_n")))
            bounds, bits = materialize(_boundary(hist, label)), finer
            held = bounds.agg(F.max("_in")).first()[0] or 0
        marked = (base.withColumn("_bin", at_bits(bits)).join(targets, label, "left")
                  .join(bounds.drop("_in"), label, "left"))
    if diagnostics is not None:
        diagnostics.update(bits=bits, ranked=held)
    if cached is not None:
        cached.unpersist()
    plain = (marked.where(F.col("_e").isNull() | (F.col("_bin") != F.col("_e")))
                   .withColumn(flag, F.col("_w").isNotNull() & (F.col("_e").isNull() | (F.col("_bin") < F.col("_e")))))
    edge_rows = marked.where(F.col("_bin") == F.col("_e"))
    if key:
        w_edge = Window.partitionBy(label, "_bin").orderBy("_h", key)
        at_edge = edge_rows.withColumn(flag, F.row_number().over(w_edge) <= F.col("_k"))
    else:
        # No key: identical rows are interchangeable.  Collapse them (map-side)
        # and rank distinct rows only; each keeps as many copies as still fit.
        cols = [c for c in marked.columns if c != flag]
        grouped = edge_rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
        w_edge = (Window.partitionBy(label, "_bin")
                  .orderBy("_h", F.to_json(F.struct(*[F.col(c) for c in df.columns])))
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        before = F.sum("_c").over(w_edge) - F.col("_c")
        grouped = grouped.withColumn("_take", F.least(F.col("_c"), F.greatest(F.lit(0), F.col("_k") - before)))
        take = (grouped.where(F.col("_take") > 0)
                       .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_take"))))
                       .withColumn(flag, F.lit(True)))
        leave = (grouped.where(F.col("_c") > F.col("_take"))
                        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_c") - F.col("_take"))))
                        .withColumn(flag, F.lit(False)))
        at_edge = take.unionByName(leave).drop("_c", "_take", "_i")
    return plain.unionByName(at_edge).drop("_h", "_bin", "_e", "_k", "_w").select(*df.columns, flag)


def undersample(df: DataFrame, label: str = LABEL, key: str | None = KEY, seed: int = 42,
                rounds: int = 1) -> DataFrame:
    """Random undersampling of the majority class, ``rounds`` times.

    A cut class keeps its ``target`` rows with the smallest (hash, key); the
    others are untouched.  Rounds compose: each cuts the currently largest
    class to the minority size, so all targets follow from the class counts
    and one pass applies them.  The counts and the rank boundaries come from
    one histogram pass; rows outside and inside the boundary bin are two more.
    """
    cut = {}

    def targets(counts: dict) -> dict:
        t = undersample_targets(counts, rounds)
        cut.update({c: v for c, v in t.items() if v < counts[c]})
        return dict(cut)

    marked = mark_smallest(df, label, key, "rank", seed, targets, "_keep")
    if not cut:
        return df
    keep = F.col("_keep") | ~F.col(label).isin(list(cut)) | F.col(label).isNull()
    return marked.where(keep).drop("_keep").select(*df.columns)
