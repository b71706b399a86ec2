"""Data contracts: strict columns, types, NULLs, value ranges and key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.sources.storage import stored

# Parts that the rows of one key are dealt to when repeated keys are looked up.
SALTS = 8


class ContractError(ValueError):
    """A batch broke its contract; the message lists the violated rules."""


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType | None = None  # None accepts any type
    nullable: bool = False
    above: float | None = None  # exclusive lower bound
    at_least: float | None = None
    coerce: bool = False  # accept other types whose values convert


@dataclass(frozen=True)
class Contract:
    dataset: str
    fields: tuple[Field, ...]
    unique: tuple[str, ...]
    ordered_pairs: tuple[tuple[str, str], ...] = ()  # (larger, smaller)


def _price(name: str) -> Field:
    return Field(name, T.DoubleType(), above=0)


def _amount(name: str) -> Field:
    return Field(name, T.DoubleType(), at_least=0)


def _optional(name: str, at_least: float | None = None) -> Field:
    return Field(name, T.DoubleType(), nullable=True, at_least=at_least, coerce=True)


# The two raw contracts.
MARKETS = Contract(
    "markets",
    (
        Field("coin_id", T.StringType()),
        Field("symbol", T.StringType()),
        Field("name", T.StringType()),
        Field("current_price", T.DoubleType(), above=0, coerce=True),
        _optional("market_cap", at_least=0),
        _optional("market_cap_rank", at_least=1),
        _optional("total_volume", at_least=0),
        _optional("price_change_percentage_24h"),
        _optional("circulating_supply", at_least=0),
        Field("last_updated", T.StringType()),
        Field("vs_currency", T.StringType()),
        Field("snapshot_date", T.TimestampNTZType(), coerce=True),
    ),
    unique=("coin_id",),
)
KLINES = Contract(
    "klines",
    (
        Field("open_time_ms", T.LongType(), above=0),
        _price("open"),
        _price("high"),
        _price("low"),
        _price("close"),
        _amount("volume"),
        Field("close_time_ms", T.LongType(), above=0),
        _amount("quote_volume"),
        Field("trade_count", T.LongType(), at_least=0),
        _amount("taker_buy_base_volume"),
        _amount("taker_buy_quote_volume"),
        Field("open_time"),
        Field("symbol", T.StringType()),
        Field("interval", T.StringType()),
    ),
    unique=("symbol", "open_time_ms"),
    ordered_pairs=(("high", "low"),),
)


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    broken: str  # SQL predicate, true for rows that break the rule


def violations(df: DataFrame, contract: Contract, batch: Sequence[str] = ()) -> DataFrame:
    """(dataset, rule, column, n): rows breaking each rule, one row per rule, zeros included.

    All row rules share one aggregate over a single scan. Uniqueness reads the key columns
    only and counts rows per key with map-side partial sums, so a hot key costs one row per
    task. `batch` columns delimit the frames keys must be unique in; they are no contract
    fields themselves.
    """
    rules = _row_rules(df, contract)
    entries = [_entry(rule.name, rule.column, f"n{i}") for i, rule in enumerate(rules)]
    entries += [_entry(name, column, "1") for name, column in _structure(df, contract, batch)]
    parts = []
    if entries:
        counts = [f"count_if({rule.broken}) AS n{i}" for i, rule in enumerate(rules)]
        parts.append(
            df.selectExpr("count(*) AS rows", *counts).selectExpr(
                f"inline(array({', '.join(entries)}))"
            )
        )
    if set(contract.unique) <= set(df.columns):
        key = ",".join(contract.unique)
        entry = f"inline(array({_entry('unique', key, 'n')}))"
        parts.append(_repeated_rows(df, [*batch, *contract.unique]).selectExpr(entry))
    found = reduce(DataFrame.unionByName, parts)
    return found.select(F.lit(contract.dataset).alias("dataset"), "rule", "column", "n")


def rejects(df: DataFrame, contract: Contract, batch: Sequence[str] = ()) -> DataFrame:
    """Rows that break any row rule or share their key, with all broken rules and the first."""
    marked = _mark_repeated(df, [*batch, *contract.unique])
    rules = _row_rules(df, contract)
    rules.append(Rule("unique", ",".join(contract.unique), "_repeated"))
    names = [f"CASE WHEN {rule.broken} THEN '{rule.name}:{rule.column}' END" for rule in rules]
    return (
        marked.filter(" OR ".join(f"({rule.broken})" for rule in rules))
        .withColumn("failed", F.expr(f"array_compact(array({', '.join(names)}))"))
        .withColumn("first_failed", F.col("failed")[0])
        .drop("_repeated")
    )


def _mark_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add `_repeated`: true where another row has the same key, NULL keys included.

    Keys are counted with map-side sums and written, so that the planner knows how many are
    repeated. Rows look their key up under a salt of their whole content, and each repeated key is
    there once for every salt, so the copies of a hot key come to SALTS tasks, which the skew join
    may split further.
    """
    names = {key: f"_key{i}" for i, key in enumerate(keys)}
    repeated = stored(
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > 1)
        .withColumnsRenamed(names)
        .drop("_n"),
        "repeated",
    )
    salted = repeated.withColumns(
        {"_key_salt": F.explode(F.array(*map(F.lit, range(SALTS)))), "_repeated": F.lit(True)}
    )
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()])
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    found = rows.join(salted, same & (F.col("_salt") == F.col("_key_salt")), "left")
    return found.drop(*names.values(), "_key_salt", "_salt")


def require(df: DataFrame, contract: Contract, batch: Sequence[str] = ()) -> DataFrame:
    """Return the frame in contract column order and types, or raise for the whole batch."""
    broken = violations(df, contract, batch).filter(F.col("n") > 0).collect()
    if broken:
        found = "; ".join(f"{row.rule}({row.column}): {row.n}" for row in broken)
        raise ContractError(f"{contract.dataset}: {found}")
    typed = [f"{_typed(df, field)} AS `{field.name}`" for field in contract.fields]
    return df.selectExpr(*typed, *batch)


def stage_checked(df: DataFrame, contract: Contract, label: str, batch: Sequence[str] = ()) -> DataFrame:
    """Write the frame once and return what was written, or raise for the whole batch.

    The row rules are counted while the rows are written, so whatever makes the frame runs once; only the key
    columns of what was written are read again. Nothing but the stage is written before the verdict. Columns and
    types that break the contract raise before any job.
    """
    structure = _structure(df, contract, batch)
    if structure:
        raise ContractError(f"{contract.dataset}: " + "; ".join(f"{name}({column}): 1" for name, column in structure))
    rules = _row_rules(df, contract)
    counted = Observation()
    watched = df.observe(counted, *[F.expr(f"count_if({r.broken})").alias(f"n{i}") for i, r in enumerate(rules)])
    typed = [f"{_typed(df, field)} AS `{field.name}`" for field in contract.fields]
    table = stored(watched.selectExpr(*typed, *batch), label)
    found = [(r.name, r.column, counted.get[f"n{i}"]) for i, r in enumerate(rules)]
    repeated = _repeated_rows(table, [*batch, *contract.unique]).first().n
    found.append(("unique", ",".join(contract.unique), repeated))
    broken = [f"{name}({column}): {n}" for name, column, n in found if n]
    if broken:
        raise ContractError(f"{contract.dataset}: " + "; ".join(broken))
    return table


def _repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n): how many rows share their key with another row."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return counts.selectExpr("coalesce(sum(n), 0) AS n")


def _entry(rule: str, column: str, n: str) -> str:
    return f"struct('{rule}' AS rule, '{column}' AS column, CAST({n} AS BIGINT) AS n)"


def _structure(
    df: DataFrame, contract: Contract, batch: Sequence[str]
) -> list[tuple[str, str]]:
    """Violations visible in the schema alone."""
    present = {field.name: field.dataType for field in df.schema}
    expected = [field.name for field in contract.fields]
    found = [("missing_column", name) for name in expected if name not in present]
    found += [
        ("unexpected_column", name) for name in present if name not in (*expected, *batch)
    ]
    found += [
        ("type", field.name)
        for field in contract.fields
        if field.name in present
        and field.type is not None
        and not field.coerce
        and present[field.name] != field.type
    ]
    return found


def _converted(df: DataFrame, field: Field) -> bool:
    return field.coerce and df.schema[field.name].dataType != field.type


def _typed(df: DataFrame, field: Field) -> str:
    """The field's value in its contract type, NULL where it does not convert."""
    if _converted(df, field):
        return f"try_cast(`{field.name}` AS {field.type.simpleString()})"
    return f"`{field.name}`"


def _row_rules(df: DataFrame, contract: Contract) -> list[Rule]:
    """Rules for the columns that exist with a usable type. NaN counts as NULL."""
    rules = []
    for field in contract.fields:
        if field.name not in df.columns:
            continue
        value = _typed(df, field)
        type_ = field.type if field.coerce else df.schema[field.name].dataType
        fractional = isinstance(type_, (T.DoubleType, T.FloatType))
        missing = f"({value} IS NULL OR isnan({value}))" if fractional else f"({value} IS NULL)"
        if _converted(df, field):
            unread = f"`{field.name}` IS NOT NULL AND {value} IS NULL"
            rules.append(Rule("convertible", field.name, unread))
        if not field.nullable:
            rules.append(Rule("not_null", field.name, missing))
        if isinstance(type_, T.NumericType):
            if field.above is not None:
                low = f"NOT {missing} AND {value} <= {field.above}"
                rules.append(Rule("greater_than", field.name, low))
            if field.at_least is not None:
                low = f"NOT {missing} AND {value} < {field.at_least}"
                rules.append(Rule("at_least", field.name, low))
    for larger, smaller in contract.ordered_pairs:
        if {larger, smaller} <= set(df.columns):
            rules.append(Rule("ordered", f"{larger}>={smaller}", f"`{larger}` < `{smaller}`"))
    return rules
