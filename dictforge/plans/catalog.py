"""Registry of queries over the given tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL forms of the text functions. The engine of the counterpart has no look-around and an ASCII ``\s``.
_WS = r"[\s\p{Z}\x1c-\x1f\x{85}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return f"regexp_replace({x}, '{_WS}+', ' ', 'g')"


def sql_unescape(x: str) -> str:
    """Entities that occur in the given tables; the ampersand comes last, so only one level is undone."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def sql_normalize(x: str) -> str:
    text = sql_collapse(sql_unescape(f"coalesce({x}, '')"))
    text = rf"regexp_replace({text}, '(\p{{Nd}}), (\p{{Nd}})', '\1,\2', 'g')"
    text = rf"regexp_replace(regexp_replace({text}, '\.\.+', '.', 'g'), ',,+', ',', 'g')"
    return f"trim(replace({text}, '+', ' '))"


def sql_valid(x: str) -> str:
    blocked = " AND ".join(
        f"NOT contains(lower({x}), '{b}')"
        for b in ("is defined as: .", "<null>", "undefined", "n/a", "अभिसम्भृत")
    )
    return (
        f"(length({x}) <= 10000 AND length({sql_strip(x)}) >= 5 AND {blocked} AND NOT "
        rf"regexp_matches(lower({x}), '(^|[^\p{{L}}\p{{N}}_])nan($|[^\p{{L}}\p{{N}}_])'))"
    )


def sql_html(x: str) -> str:
    text = sql_unescape(f"coalesce({x}, '')")
    bodies = "|".join(rf"<{tag}\b[^>]*>.*?</{tag}\s*>" for tag in ("script", "style", "template"))
    text = f"regexp_replace({text}, '(?is)<!--.*?-->|{bodies}|</?[a-z!][^>]*>', ' ', 'g')"
    return f"trim({sql_collapse(sql_unescape(text))})"


def sql_key(prompt: str, target: str) -> str:
    return f"md5({sql_strip(f'''concat({prompt}, '|', substr({target}, 1, 500))''')})"
