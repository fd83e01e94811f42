"""Cleaning of tables: names, types, keys, duplicates, rules and contracts."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.frames import value_at


def snake_names(df: DataFrame) -> DataFrame:
    """Columns in snake case; names that fall together get ``_2``, ``_3``."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        n = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", re.sub(r"(.)([A-Z][a-z]+)", r"\1_\2", c.strip()))
        n = re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z]+", "_", n)).strip("_").lower() or "col"
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*names)


# Columns that an index left behind, and columns that tell the future.
INDEX_RESIDUE = r"^(index|level_0|unnamed_[0-9_]+|index_level_[0-9_]+)$"
LOOK_AHEAD = ("excessreturn", "pricechange", "spychange")


def without_residue(df: DataFrame, also: tuple[str, ...] = (), prefix: str = "source_") -> DataFrame:
    """``df`` without index residue, columns that tell the future, source flags and those named in ``also``."""
    gone = [c for c in df.columns if re.match(INDEX_RESIDUE, re.sub(r"[^0-9a-z]+", "_", c.strip().lower()).strip("_"))
            or re.sub(r"[^a-z]", "", c.lower()) in LOOK_AHEAD or c.lower().startswith(prefix) or c in also]
    return df.drop(*gone)


def one_symbol(df: DataFrame, name: str = "symbol") -> DataFrame:
    """``name`` and its numbered copies as one column, the first that is not null; ``conflict`` tells that two of them differ."""
    copies = [c for c in df.columns if re.fullmatch(rf"{re.escape(name)}(_\d+)?", c)]
    values = F.array_distinct(F.array_compact(F.array(*copies)))
    return df.withColumns({"conflict": F.size(values) > 1, name: F.coalesce(*copies)}).drop(*[c for c in copies if c != name])


def with_any(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that have a value in one of ``columns`` at least."""
    return df.where(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull())


def first_of(df: DataFrame, target: str, aliases: list[str]) -> DataFrame:
    """One column from the first present alias with a value; case and spaces do not count."""
    plain = {re.sub(r"[\s_]", "", c).lower(): c for c in df.columns}
    found = [plain[k] for a in aliases if (k := re.sub(r"[\s_]", "", a).lower()) in plain]
    value = F.coalesce(*[F.col(f"`{c}`") for c in found]) if found else F.lit(None).cast("string")
    return df.withColumn(target, value).drop(*[c for c in found if c != target])


def last_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the first by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def project(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Exactly the contract's columns, cast, missing ones null."""
    have = set(df.columns)
    return df.select([(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in contract.items()])


_COMPARE = {
    "eq": lambda c, v: c == v, "ne": lambda c, v: c != v, "gt": lambda c, v: c > v, "gte": lambda c, v: c >= v, "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v,
}
#: Operators that each kind of value allows.
KINDS = {
    "number": {*_COMPARE, "in", "not_in", "is_null", "is_not_null"}, "date": {*_COMPARE, "in", "not_in", "is_null", "is_not_null"},
    "string": {"eq", "ne", "in", "not_in", "is_null", "is_not_null"}, "boolean": {"eq", "ne", "is_null", "is_not_null"},
}


def rule(tree: dict, kinds: dict[str, str]) -> Column:
    """A nested rule tree as one predicate.

    Groups are ``{"and": [...]}`` or ``{"or": [...]}``; leaves have field, op
    and value or values. A null never satisfies an ordinary operator.
    """
    for word in ("and", "or"):
        if word in tree:
            parts = [rule(t, kinds) for t in tree[word]]
            if not parts:
                raise ValueError("empty group")
            out = parts[0]
            for p in parts[1:]:
                out = (out & p) if word == "and" else (out | p)
            return out
    field, op = tree["field"], tree["op"]
    if field not in kinds or op not in KINDS[kinds[field]]:
        raise ValueError(f"operator {op} does not apply to field {field}")
    c = F.col(field)
    if op == "is_null":
        return c.isNull()
    if op == "is_not_null":
        return c.isNotNull()
    if op in ("in", "not_in"):
        hit = c.isin(*tree["values"])
        return F.coalesce(hit if op == "in" else ~hit, F.lit(False))
    value = F.lit(tree["value"])
    return F.coalesce(_COMPARE[op](c, value.cast("date") if kinds[field] == "date" else value), F.lit(False))


def field_catalog(df: DataFrame) -> list[tuple[str, str, list[str]]]:
    """Fields that rules may use: name, kind, operators."""
    kind = {"double": "number", "float": "number", "int": "number", "bigint": "number", "date": "date", "timestamp": "date", "string": "string", "boolean": "boolean"}
    return [(c, kind[t], sorted(KINDS[kind[t]])) for c, t in df.dtypes if t in kind]


def purge(df: DataFrame, column: str, op: str, threshold: float) -> DataFrame:
    """Rows that a purge rule selects; percent rules take whole ties."""
    if op in _COMPARE:
        return df.where(F.coalesce(_COMPARE[op](F.col(column), F.lit(threshold)), F.lit(False)))
    edge = {"top_percent": 1 - threshold / 100, "bottom_percent": threshold / 100}[op]
    n = df.agg(F.count(column)).first()[0]
    if n == 0:
        return df.limit(0)
    at = edge * (n - 1)
    low, high = (value_at(df, column, k)[0] for k in (math.floor(at), math.ceil(at)))
    cut = F.lit(low + (high - low) * (at - math.floor(at)))
    return df.where(F.col(column) >= cut if op == "top_percent" else F.col(column) <= cut)


def rotation(df: DataFrame, key: str, cursor: int, size: int) -> DataFrame:
    """A wrap-around slice of the rows sorted by a key, null keys first, with their ``position`` from the cursor.

    The key at the slice's start is looked up, then only the ``size`` rows from
    there on are sorted; rows of one key stand in any order.
    """
    n, nulls = df.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    if n == 0:
        return df.limit(0).withColumn("position", F.lit(0))
    start, size = cursor % n, min(size, n)

    def part(begin: int, count: int, first: int) -> DataFrame:
        if begin < nulls:
            rows, skipped = df, 0
        else:
            value, under = value_at(df, key, begin - nulls)
            rows, skipped = df.where(F.col(key) >= F.lit(value)), nulls + under
        rows = rows.orderBy(key).offset(begin - skipped).limit(count)
        return rows.withColumn("position", F.row_number().over(Window.orderBy(key)) + (first - 1))

    ahead = min(size, n - start)
    out = part(start, ahead, 0)
    return out.unionByName(part(0, size - ahead, ahead)) if size > ahead else out


def available(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag a provider says yes to, in whatever words; anything else is no."""
    from tapeloom.functions.scalars import truth

    return df.where(F.coalesce(truth(F.col(flag).cast("string")), F.lit(False)))


def first_per(df: DataFrame, keys: list[str], most: int, *order: Column, place: str = "turn") -> DataFrame:
    """The first ``most`` rows of each key by ``order``, numbered from 1 in ``place``: what a batch of that size takes.

    Tasks drop what cannot be among the first before the exchange, so a key with very many rows sends ``most`` a task.
    """
    from pyspark.sql import Window

    return df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(place) <= most)
