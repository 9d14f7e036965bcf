"""Star enrichment: the fact joined to its dimensions by key.

Semantics kept from the job this replaces: inner joins, NULL keys never
match, and a duplicated dimension key fans the fact out (``dim_key_uniqueness``
reports such keys so that the caller can stop before totals double).

Output names are unique: every dimension attribute is prefixed, so no
column needs a relation alias to be resolved later.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DimSpec:
    """How one dimension joins the fact; ``columns`` maps output name ->
    dimension column. The join strategy is Spark's: from table sizes when it
    plans, from measured shuffle sizes when it runs (AQE)."""
    name: str
    df: DataFrame
    fact_key: str
    dim_key: str
    columns: dict = field(default_factory=dict)
    how: str = "inner"


def _dim_side(spec: DimSpec) -> DataFrame:
    key_alias = f"__{spec.name}_key"
    cols = [F.col(spec.dim_key).alias(key_alias)]
    cols += [F.col(src).alias(out) for out, src in spec.columns.items()]
    return spec.df.select(*cols)


def join_dim(fact: DataFrame, spec: DimSpec) -> DataFrame:
    dim = _dim_side(spec)
    key_alias = f"__{spec.name}_key"
    joined = fact.join(dim, fact[spec.fact_key] == dim[key_alias], spec.how)
    return joined.drop(key_alias)


def star_join(fact: DataFrame, specs: list[DimSpec]) -> DataFrame:
    """Join dimensions in the given order (put same-key joins next to each
    other so a shuffle's partitioning is reused)."""
    out = fact
    for spec in specs:
        out = join_dim(out, spec)
    return out


def orphans(fact: DataFrame, spec: DimSpec) -> DataFrame:
    """Fact rows whose key finds no dimension row (dropped by an inner join).

    NULL keys are orphans too: they never match.
    """
    keys = spec.df.select(F.col(spec.dim_key).alias("__k"))
    return fact.join(keys, fact[spec.fact_key] == keys["__k"], "left_anti")


def orphan_report(fact: DataFrame, specs: list[DimSpec]) -> DataFrame:
    """Per dimension: how many fact rows an inner join with it would drop.

    One pass over the fact makes a (key column, key) row of each of its join
    keys, the dimensions add the keys they know, each as a bit, and one grouping
    by (key column, key) meets both: what is shuffled has the size of the
    distinct keys, a hot key is one row of a task, and the fact is never
    joined. NULL keys never match, so they count as orphans.
    """
    keys = list(dict.fromkeys(s.fact_key for s in specs))

    def row(which: int, key: Column, n: int, known: int) -> Column:
        typed = [(key if i == which else F.lit(None)).cast(fact.schema[k].dataType).alias(f"k{i}")
                 for i, k in enumerate(keys)]
        return F.struct(F.lit(which).alias("which"), *typed, F.lit(n).cast("bigint").alias("n"),
                        F.lit(known).cast("bigint").alias("known"))

    rows = fact.select(F.inline(F.array(*[row(i, F.col(k), 1, 0) for i, k in enumerate(keys)])))
    for bit, s in enumerate(specs):
        which = keys.index(s.fact_key)
        same = F.col(s.dim_key).try_cast(fact.schema[s.fact_key].dataType)
        known = s.df.where(same == F.col(s.dim_key)).select(row(which, same, 0, 1 << bit).alias("r"))
        rows = rows.unionByName(known.select("r.*"))
    met = rows.groupBy("which", *[f"k{i}" for i in range(len(keys))]).agg(
        F.sum("n").alias("n"), F.bit_or("known").alias("known"))
    lost = [F.sum(F.when((F.col("which") == keys.index(s.fact_key))
                         & (F.col("known").bitwiseAND(1 << bit) == 0), F.col("n"))).alias(f"lost{bit}")
            for bit, s in enumerate(specs)]
    out = [F.struct(F.lit(s.name).alias("dimension"),
                    F.coalesce(f"lost{bit}", F.lit(0)).cast("bigint").alias("orphan_rows"))
           for bit, s in enumerate(specs)]
    return met.agg(*lost).select(F.inline(F.array(*out)))


MISSING = "missing"


def with_missing(fact: DataFrame, specs: list[DimSpec]) -> DataFrame:
    """Every fact row once, with ``missing``: the names of the dimensions that
    do not hold its key (a null key is held by none). The dimensions come with
    their distinct keys, so a duplicated key multiplies nothing here."""
    out, marks = fact, []
    for i, spec in enumerate(specs):
        mark = f"__has_{i}"
        keys = (spec.df.where(F.col(spec.dim_key).isNotNull())
                .select(F.col(spec.dim_key).alias(f"__k_{i}")).distinct().withColumn(mark, F.lit(True)))
        out = out.join(keys, out[spec.fact_key] == keys[f"__k_{i}"], "left").drop(f"__k_{i}")
        marks.append(F.when(F.col(mark).isNull(), F.lit(spec.name)))
    columns = [F.col(c) for c in fact.columns if c != MISSING]
    return out.select(*columns, F.array_compact(F.array(*marks)).alias(MISSING))


def settled_rows(marked: DataFrame) -> DataFrame:
    """The rows of ``with_missing`` that every dimension knows."""
    return marked.where(F.size(MISSING) == 0).drop(MISSING)


def parked_rows(marked: DataFrame) -> DataFrame:
    """The others, with what they miss: an inner join would lose them. Kept,
    they can be settled when a later version of a dimension holds the key."""
    return marked.where(F.size(MISSING) > 0)


def retry_parked(parked: DataFrame, specs: list[DimSpec]) -> DataFrame:
    """Parked rows marked anew by later dimensions: only the dimensions that a
    row missed are asked, and rows with a null key there are passed on as they
    are. Dimensions that knew a row's key are taken to know it still."""
    out = parked
    for i, spec in enumerate(specs):
        mark = f"__has_{i}"
        keys = (spec.df.where(F.col(spec.dim_key).isNotNull())
                .select(F.col(spec.dim_key).alias(f"__k_{i}")).distinct().withColumn(mark, F.lit(True)))
        asked = F.array_contains(MISSING, spec.name) & (out[spec.fact_key] == keys[f"__k_{i}"])
        out = out.join(keys, asked, "left").drop(f"__k_{i}")
        out = out.withColumn(MISSING, F.when(F.col(mark), F.array_remove(MISSING, spec.name))
                             .otherwise(F.col(MISSING))).drop(mark)
    return out


def dim_key_uniqueness(dim: DataFrame, key: str) -> DataFrame:
    """Keys present more than once (each would multiply matching facts)."""
    return (dim.groupBy(F.col(key).alias("key"))
            .agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))
