"""

A control is one number, ``violation_count``; PASS iff it is 0.  Each
control is a combination of *scalars*; a scalar is an aggregate expression
over a *source* (a model table, a filtered table, the groups of a table
that break a HAVING rule, the rows of a table missing from another, or an
inner join).  Predicates and aggregates are Spark SQL expressions
(``F.expr``), evaluated JVM-side by Catalyst; the same text runs in the
DuckDB oracle.

Scale: every scalar is a global (or grouped) aggregate, so a control is one
partial + final aggregation per source; nothing is collected except the
one-row result.  Row rules on the same table are batched into a single
aggregate pass (see ``quality.controls.evaluate``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.operators.distinct import prints


@dataclass(frozen=True)
class Table:
    name: str
    where: str | None = None

    def spark(self, p) -> DataFrame:
        df = getattr(p, self.name)
        return df.filter(F.expr(self.where)) if self.where else df

    def sql(self) -> str:
        return f"{self.name}" + (f" WHERE {self.where}" if self.where else "")


@dataclass(frozen=True)
class Groups:
    """Groups of ``table`` (by ``keys``) for which ``having`` holds."""
    name: str
    keys: tuple[str, ...]
    having: str
    where: str | None = None

    def spark(self, p) -> DataFrame:
        df = Table(self.name, self.where).spark(p)
        return (df.groupBy(*self.keys).agg(F.expr(self.having).alias("_bad"))
                .filter(F.col("_bad")).drop("_bad"))

    def sql(self) -> str:
        w = f" WHERE {self.where}" if self.where else ""
        k = ", ".join(self.keys)
        return f"(SELECT {k} FROM {self.name}{w} GROUP BY {k} HAVING {self.having}) g"


@dataclass(frozen=True)
class Missing:
    """``keys`` of ``a`` with no row in ``b`` (left anti join): distinct, or every
    row with ``rows``."""
    a: str
    b: str
    keys: tuple[str, ...]
    where_a: str | None = None
    where_b: str | None = None
    rows: bool = False

    def spark(self, p) -> DataFrame:
        da = Table(self.a, self.where_a).spark(p).select(*self.keys)
        da = da if self.rows else da.distinct()
        db = Table(self.b, self.where_b).spark(p).select(*self.keys).distinct()
        return da.join(db, list(self.keys), "left_anti")

    def sql(self) -> str:
        wa = f" WHERE {self.where_a}" if self.where_a else ""
        wb = f" WHERE {self.where_b}" if self.where_b else ""
        k = ", ".join(self.keys)
        cond = " AND ".join(f"x.{c} = y.{c}" for c in self.keys)
        return (f"(SELECT {'' if self.rows else 'DISTINCT '}{k} FROM {self.a}{wa}) x WHERE NOT EXISTS "
                f"(SELECT 1 FROM (SELECT DISTINCT {k} FROM {self.b}{wb}) y WHERE {cond})")


@dataclass(frozen=True)
class Joined:
    """Inner join of ``a`` (alias o) and ``b`` (alias t) on same-named keys."""
    a: str
    b: str
    keys: tuple[str, ...]

    def spark(self, p) -> DataFrame:
        o = getattr(p, self.a).alias("o")
        t = getattr(p, self.b).alias("t")
        cond = None
        for k in self.keys:
            c = F.col(f"o.{k}") == F.col(f"t.{k}")
            cond = c if cond is None else cond & c
        return o.join(t, cond, "inner")

    def sql(self) -> str:
        cond = " AND ".join(f"o.{k} = t.{k}" for k in self.keys)
        return f"{self.a} o JOIN {self.b} t ON {cond}"


@dataclass(frozen=True)
class Scalar:
    source: object
    agg: str
    agg_sql: str | None = None  # DuckDB spelling when it differs from Spark's


@dataclass
class Control:
    stage: str
    control_id: str
    klass: str
    scalars: dict[str, Scalar]
    combine: str  # SQL expression over scalar names -> violation count
    tables: tuple[str, ...] = field(default_factory=tuple)

    def sql(self) -> str:
        parts = []
        for name, s in self.scalars.items():
            parts.append(f"(SELECT {s.agg_sql or s.agg} AS {name} FROM {s.source.sql()}) AS s_{name}")
        return f"SELECT CAST({self.combine} AS BIGINT) AS violation_count FROM {', '.join(parts)}"


# ---- class constructors ------------------------------------------------------

def row_rule(stage, cid, table, pred, where=None):
    """C: rows breaking a predicate."""
    return Control(stage, cid, "row_rule", {"v": Scalar(Table(table, where), f"count_if({pred})")},
                   "COALESCE(v, 0)", (table,))


def unique_grain(stage, cid, table, cols):
    """B: COUNT(*) - COUNT(DISTINCT key); a composite key counts NULL fields.  Spark counts the 96-bit
    prints of a single key (see ``operators.distinct``): a third of the key's bytes are shuffled."""
    if len(cols) == 1:
        d, d_sql = f"COUNT(DISTINCT {', '.join(prints(cols[0]))})", f"COUNT(DISTINCT {cols[0]})"
    else:
        d = "COUNT(DISTINCT struct(" + ", ".join(cols) + "))"
        d_sql = "COUNT(DISTINCT row(" + ", ".join(cols) + "))"
    return Control(stage, cid, "unique_grain",
                   {"v": Scalar(Table(table), f"COUNT(*) - {d}", f"COUNT(*) - {d_sql}")}, "v", (table,))


def count_parity(stage, cid, a, b, where_a=None, where_b=None, agg_a="COUNT(*)", agg_b="COUNT(*)"):
    """A: |count(a) - count(b)|."""
    return Control(stage, cid, "count_parity",
                   {"a": Scalar(Table(a, where_a), agg_a), "b": Scalar(Table(b, where_b), agg_b)},
                   "ABS(a - b)", (a, b))


def total_parity(stage, cid, pairs, tol=None):
    """D: totals equal (exactly, or within ``tol``); a NULL total is a violation.
    ``pairs`` = [((table, agg, where), (table, agg, where)), ...] all must hold."""
    scalars, conds, tables = {}, [], []
    for i, ((ta, ea, wa), (tb, eb, wb)) in enumerate(pairs):
        scalars[f"a{i}"] = Scalar(Table(ta, wa), ea)
        scalars[f"b{i}"] = Scalar(Table(tb, wb), eb)
        tables += [ta, tb]
        conds.append(f"ABS(a{i} - b{i}) <= {tol}" if tol is not None else f"a{i} = b{i}")
    return Control(stage, cid, "total_parity", scalars,
                   f"CASE WHEN {' AND '.join(conds)} THEN 0 ELSE 1 END", tuple(dict.fromkeys(tables)))


def group_rule(stage, cid, table, keys, having, where=None):
    """E: groups whose aggregate breaks a HAVING rule."""
    return Control(stage, cid, "group_rule", {"v": Scalar(Groups(table, tuple(keys), having, where), "COUNT(*)")},
                   "v", (table,))


def no_orphans(stage, cid, a, b, keys, where_a=None, where_b=None, rows=False):
    """F: keys (or rows) of a without a match in b."""
    return Control(stage, cid, "anti_join", {"v": Scalar(Missing(a, b, tuple(keys), where_a, where_b, rows), "COUNT(*)")},
                   "v", (a, b))


def join_rule(stage, cid, a, b, keys, pred):
    """R: joined rows breaking a cross-table formula."""
    return Control(stage, cid, "join_rule", {"v": Scalar(Joined(a, b, tuple(keys)), f"count_if({pred})")},
                   "COALESCE(v, 0)", (a, b))


def must_exist(stage, cid, table, pred):
    """V: at least one row of a kind must exist."""
    return Control(stage, cid, "must_exist", {"v": Scalar(Table(table), f"count_if({pred})")},
                   "CASE WHEN v > 0 THEN 0 ELSE 1 END", (table,))


def composite(stage, cid, parts: list[Control]):
    """G: sum of several controls."""
    scalars, terms, tables = {}, [], []
    for i, part in enumerate(parts):
        rename = {}
        for name, s in part.scalars.items():
            rename[name] = f"p{i}_{name}"
            scalars[f"p{i}_{name}"] = s
        expr = part.combine
        for old in sorted(rename, key=len, reverse=True):
            expr = re.sub(rf"\b{old}\b", rename[old], expr)
        terms.append(f"({expr})")
        tables += list(part.tables)
    return Control(stage, cid, "composite", scalars, " + ".join(terms), tuple(dict.fromkeys(tables)))
