"""Data tests as Spark jobs (Q1-Q6).

A test returns its number of failing records, with the usual semantics of warehouse data
tests: ``unique`` ignores NULLs and counts duplicated values; ``relationships`` counts
child rows (non-NULL key) without a parent; ``accepted_values`` counts distinct values
outside the list (NULLs pass); ``unique_combination`` counts duplicated combinations.

A suite is three kinds of jobs, whatever its number of tests: per table one scan and one
aggregation for all its NULL and relationship checks (parents' key sets are broadcast behind
a size check); per table with accepted-value checks one scan of the rows outside the lists
(pushed-down ``NOT IN``); and one shuffle for all uniqueness tests of all tables together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .joins import fits_broadcast

RESULT_COLUMNS = ["test_name", "model", "column_name", "failures"]


@dataclass(frozen=True)
class DataTest:
    kind: str                      # not_null | unique | relationships | accepted_values | unique_combination
    model: str
    columns: tuple[str, ...]
    parent: str | None = None      # relationships: parent model
    parent_field: str | None = None
    values: tuple = field(default_factory=tuple)  # accepted_values

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{'_'.join(self.columns)}"


def _row(t: DataTest, failures: Column) -> Column:
    return F.struct(
        F.lit(t.name).alias("test_name"), F.lit(t.model).alias("model"),
        F.lit(t.column_name).alias("column_name"), failures.cast("bigint").alias("failures"),
    )


def accepted_values_checks(df: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """Distinct values outside the lists. Only rows outside some list are read: ``NOT IN`` is pushed into the
    Parquet scan, whose dictionary filter skips row groups holding accepted values only."""
    outside = [~F.col(t.columns[0]).isin(*t.values) for t in tests]
    some = outside[0]
    for o in outside[1:]:
        some = some | o
    cells = F.array(*[F.struct(F.lit(i).alias("_i"), F.when(o, F.col(t.columns[0]).cast("string")).alias("_v")) for i, (t, o) in enumerate(zip(tests, outside))])
    bad = df.where(some).select(F.explode(cells).alias("_c")).select("_c.*").where("_v IS NOT NULL").distinct()
    a = bad.agg(*[F.count_if(F.col("_i") == i).alias(f"_f{i}") for i in range(len(tests))])
    return a.select(F.inline(F.array(*[_row(t, F.col(f"_f{i}")) for i, t in enumerate(tests)])))


def unique_checks(tables: dict[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    """All uniqueness tests of all tables in one shuffle of (table, integer key or key text), partially aggregated.

    Each key has a count per test of its table, so a value that a row holds under several tests crosses the shuffle once."""
    by_model: dict[str, list[int]] = {}
    for i, t in enumerate(tests):
        by_model.setdefault(t.model, []).append(i)
    most, parts = max(len(own) for own in by_model.values()), []
    for m, (model, own) in enumerate(by_model.items()):
        df, keys = tables[model], []
        for i in own:
            t, number, text = tests[i], F.lit(None).cast("long"), F.lit(None).cast("string")
            if t.kind == "unique":
                if isinstance(df.schema[t.columns[0]].dataType, IntegralType):
                    number = F.col(t.columns[0]).cast("long")
                else:
                    text = F.col(t.columns[0]).cast("string")
            else:  # NULL parts count as values; lengths keep the parts apart
                text = F.concat(*[F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in t.columns])
            keys.append((number, text))
        cells = []
        for j, (number, text) in enumerate(keys):
            same = [number.eqNullSafe(n) & text.eqNullSafe(s) for n, s in keys]
            held = [F.lit(True) if k == j else same[k] if k > j else F.lit(False) for k in range(len(keys))]
            first = F.lit(True)
            for k in range(j):
                first = first & ~same[k]
            counts = [h.cast("int") for h in held] + [F.lit(0)] * (most - len(keys))
            cell = F.struct(F.lit(m).alias("_m"), number.alias("_n"), text.alias("_t"), *[c.alias(f"_c{k}") for k, c in enumerate(counts)])
            cells.append(F.when(first & (number.isNotNull() | text.isNotNull()), cell))
        cell = F.explode(F.array(*cells)) if len(cells) > 1 else cells[0]
        parts.append(df.select(cell.alias("_c")).where("_c IS NOT NULL").select("_c.*"))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    dup = stacked.groupBy("_m", "_n", "_t").agg(*[F.sum(f"_c{k}").alias(f"_many{k}") for k in range(most)]).where(" OR ".join(f"_many{k} > 1" for k in range(most)))
    place = {i: (m, k) for m, own in enumerate(by_model.values()) for k, i in enumerate(own)}
    a = dup.agg(*[F.count_if((F.col("_m") == place[i][0]) & (F.col(f"_many{place[i][1]}") > 1)).alias(f"_f{i}") for i in range(len(tests))])
    return a.select(F.inline(F.array(*[_row(t, F.col(f"_f{i}")) for i, t in enumerate(tests)])))


def relationships_check(child: DataFrame, parent: DataFrame, t: DataTest) -> DataFrame:
    c = child.where(F.col(t.columns[0]).isNotNull()).select(F.col(t.columns[0]).alias("_k"))
    keys = parent.select(F.col(t.parent_field).alias("_k")).distinct()
    # distinct keys <= parent rows: the parent's (remembered) row count bounds the side
    p = F.broadcast(keys) if fits_broadcast(parent) else keys
    orphans = c.join(p, "_k", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("_f")).select(F.inline(F.array(_row(t, F.col("_f")))))


def row_checks(df: DataFrame, parents: dict[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    """All ``not_null`` and ``relationships`` tests of one table in a single scan and aggregation.

    Each parent's distinct key set is broadcast (size-checked) and left-joined as a lookup;
    a child row fails a relationship when its key is not NULL and found no parent. Without a
    shuffle of the child, whatever its size; parents too large to broadcast fall back to
    one anti join each.
    """
    large = [t for t in tests if t.kind == "relationships" and not fits_broadcast(parents[t.parent])]
    parts = [relationships_check(df, parents[t.parent], t) for t in large]
    rest = [t for t in tests if t not in large]
    if rest:
        c = df.select(*sorted({t.columns[0] for t in rest}))
        counts = []
        for i, t in enumerate(rest):
            value = F.col(t.columns[0])
            if t.kind == "relationships":
                keys = parents[t.parent].select(F.col(t.parent_field).alias(f"_p{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
                c = c.join(F.broadcast(keys), c[t.columns[0]] == keys[f"_p{i}"], "left").drop(f"_p{i}")
                counts.append(F.count_if(value.isNotNull() & F.col(f"_hit{i}").isNull()).alias(f"_f{i}"))
            elif t.kind == "not_null":
                counts.append(F.count_if(value.isNull()).alias(f"_f{i}"))
            else:
                raise ValueError(t.kind)
        parts.append(c.agg(*counts).select(F.inline(F.array(*[_row(t, F.col(f"_f{i}")) for i, t in enumerate(rest)]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_suite(tables: dict[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    """Evaluate every test; one row per test with its failure count (Q6)."""
    rows: dict[str, list[DataTest]] = {}
    accepted: dict[str, list[DataTest]] = {}
    unique = [t for t in tests if t.kind in ("unique", "unique_combination")]
    for t in tests:
        if t.kind in ("not_null", "relationships"):
            rows.setdefault(t.model, []).append(t)
        elif t.kind == "accepted_values":
            accepted.setdefault(t.model, []).append(t)
        elif t not in unique:
            raise ValueError(t.kind)
    parts = [row_checks(tables[model], tables, ts) for model, ts in rows.items()]
    parts += [accepted_values_checks(tables[model], ts) for model, ts in accepted.items()]
    if unique:
        parts.append(unique_checks(tables, unique))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*RESULT_COLUMNS)
