"""Building blocks for the SQL each query is checked against."""

from __future__ import annotations

import functools
import re

TABLES = {
    "region": "r_regionkey INTEGER, r_name VARCHAR",
    "nation": "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, "
    "l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
}


def ratio(top: str, bottom: str, scale: int = 4) -> str:
    """top / bottom in ten-thousandths, rounded half away from zero once, without floating point."""
    t, b = f"CAST(({top})*CAST(10000 AS BIGINT) AS HUGEINT)", f"CAST(({bottom})*CAST(10000 AS BIGINT) AS HUGEINT)"
    return (
        f"CAST((sign({t})*sign({b})*((abs({t})*{2 * 10**scale}+abs({b}))//nullif(2*abs({b}),0)))"
        f"/CAST({10**scale} AS DOUBLE) AS DECIMAL(18,{scale}))"
    )


def percent(part: str, whole: str) -> str:
    return ratio(f"100*({part})", whole, 2)


def mean(value: str, scale: int = 2) -> str:
    return ratio(f"sum({value})", f"count({value})", scale)


def mean_over(value: str, window: str, scale: int = 2) -> str:
    return ratio(f"sum({value}) OVER ({window})", f"count({value}) OVER ({window})", scale)


def near(value: str, places: int = 2) -> str:
    """Float rounding: nearest, halves to even."""
    return f"round_even(({value})*{10**places}.0e0, 0)/{10**places}.0e0"


def case(column: str, steps: list[tuple[object, str]], otherwise: str) -> str:
    arms = " ".join(f"WHEN {column} >= {bound} THEN '{label}'" for bound, label in steps)
    return f"CASE {arms} ELSE '{otherwise}' END"


class Catalog:
    """Named sub-queries; ``sql`` puts the ones a body needs in front of it."""

    def __init__(self) -> None:
        self.parts: dict[str, str] = {}

    def add(self, name: str, body: str) -> None:
        self.parts[name] = body

    def _needs(self, body: str) -> list[str]:
        words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)", body))
        return [name for name in self.parts if name in words]

    def sql(self, body: str) -> str:
        needed: dict[str, None] = {}

        def visit(text: str) -> None:
            for name in self._needs(text):
                if name not in needed:
                    visit(self.parts[name])
                    needed[name] = None

        visit(body)
        head = ",\n".join(f"{name} AS MATERIALIZED (\n{self.parts[name]}\n)" for name in needed)
        return f"WITH {head}\n{body}" if head else body


@functools.cache
def _empty_tables():
    import duckdb

    connection = duckdb.connect()
    for name, columns in TABLES.items():
        connection.execute(f"CREATE TABLE {name} ({columns})")
    return connection


def outer(sql: str) -> str:
    """Cast each output column to the convention the registered queries present."""
    described = _empty_tables().execute(f"DESCRIBE {sql}").fetchall()
    columns = []
    for name, kind, *_ in described:
        if kind.startswith("DECIMAL"):
            cast = f"CAST({name} AS DOUBLE)"
        elif kind in ("DOUBLE", "FLOAT"):
            cast = f"round({name}, 4) + 0.0"
        elif kind.endswith("INT") or kind in ("INTEGER", "BOOLEAN"):
            cast = f"CAST({name} AS BIGINT)"
        elif kind == "DATE":
            cast = f"CAST({name} AS VARCHAR)"
        elif kind.startswith("TIMESTAMP"):
            cast = f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"
        else:
            cast = name
        columns.append(f"{cast} AS {name}")
    return f"SELECT {', '.join(columns)} FROM (\n{sql}\n) AS result"
