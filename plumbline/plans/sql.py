"""One SQL text for Spark and its oracle: the few names on which the two differ are written as $NAME."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from plumbline.sources.fixtures import TABLES, VIEWS
from plumbline.sources.parameters import MONTAGE_VIEWS

SPARK = {"PCT": "percentile", "US": "unix_micros", "KURT": "kurtosis"}
DUCK = {"PCT": "quantile_cont", "US": "epoch_us", "KURT": "kurtosis_pop"}
_POS = re.compile(r"\$POS\((\w+), (\w+), (\w+)\)")
_SKEW = re.compile(r"\$SKEW\((\w+)\)")
_EACH = re.compile(r"\$EACH\(([^()]+)\)")
_SHA = re.compile(r"\$SHA\((\$JOIN\([^()]+\)|[^()$]+)\)")
_JOIN = re.compile(r"\$JOIN\(([^()]+)\)")


def spark_sql(text: str) -> str:
    text = _POS.sub(r"SELECT \3, pos, v FROM \2 LATERAL VIEW posexplode(\1) e AS pos, v", text)
    text = _SHA.sub(r"sha2(\1, 256)", text)
    text = _SKEW.sub(r"skewness(\1)", text)
    text = _EACH.sub(r"LATERAL VIEW explode(array(\1)) e AS metric", text)
    text = _JOIN.sub(r"array_join(array_sort(collect_list(\1)), ',')", text)
    return re.sub(r"\$(\w+)", lambda m: SPARK[m[1]], text).replace("unix_micros(ts)", "unix_micros(CAST(ts AS TIMESTAMP))")


def duck_sql(text: str) -> str:
    text = _SHA.sub(r"sha256(\1)", text)
    text = _EACH.sub(r", UNNEST([\1]) AS e(metric)", text)
    text = _POS.sub(r"SELECT \3, UNNEST(range(0, len(\1))) AS pos, UNNEST(\1) AS v FROM \2", text)
    mean = r"(avg(\1 * \1 * \1) - 3 * avg(\1) * avg(\1 * \1) + 2 * avg(\1) ** 3)"
    text = _SKEW.sub(mean.replace("\\1", r"\1") + r" / nullif(var_pop(\1), 0) ** 1.5", text)
    text = _JOIN.sub(r"array_to_string(list_sort(list(\1)), ',')", text)
    return re.sub(r"\$(\w+)", lambda m: DUCK[m[1]], text)


def with_views(text: str, extra: dict[str, str] | None = None) -> str:
    """The text after a WITH clause of the views it uses, directly or through others."""
    views = VIEWS | MONTAGE_VIEWS | (extra or {})
    used: list[str] = []

    def need(sql: str) -> None:
        for name in views:
            if name not in used and re.search(rf"\b(?:FROM|JOIN)\s+\(?{name}\b|,\s*{name}\b\s+\w", sql):
                need(views[name])
                if name not in used:
                    used.append(name)

    need(text)
    clause = ", ".join(f"{n} AS ({views[n]})" for n in used)
    text = text.strip()
    recursive = text.startswith("WITH RECURSIVE ")
    body = text.removeprefix("WITH RECURSIVE ").removeprefix("WITH ") if text.startswith("WITH ") else None
    if not clause:
        return text
    head = "WITH RECURSIVE " if recursive else "WITH "
    return f"{head}{clause}, {body}" if body else f"{head}{clause} {text}"


def run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The query over the tables of a folder, all of it lazy."""
    sql = spark_sql(with_views(text))
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"\b{t}\b", sql)}
    for t in frames:
        sql = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(sql, **frames)
