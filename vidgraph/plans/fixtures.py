"""Stand-in inputs derived from the driver's tables (whole tables, no row caps).

The same SQL text runs in Spark (``spark.sql(text, part=..., lineitem=...)``)
and in DuckDB (views ``part`` / ``lineitem``), so the oracle sees exactly the
rows the Spark job sees.  The fixtures only shape rows into the schemas the
jobs expect; no job reads anything from how they are made.

* ``videos_fx``  - typed catalogue, one row per part, with null attributes.
* ``related_fx`` - "bought next in the same order" pairs of line items as a
  directed multiset: duplicates, null endpoints, and endpoints outside the
  catalogue (prefix ``x``, i.e. videos never crawled) on both sides.
* ``raw_lines_fx`` - dirty crawl lines (quotes, BOM, NBSP, blank and empty
  lines, bad numbers, U+FFFD where the report's query puts invalid bytes); related IDs are parts bought next, so targets grow with
  the tables; batch 2 re-crawls the parts with ``p_size > 45``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TAB, BOM, NBSP, BAD = "\t", "\ufeff", "\u00a0", "\ufffd"

VIDEOS_FX = """
select 'v' || cast(p_partkey as string) as videoId,
       case when p_size > 48 then null else p_brand end as uploader,
       cast(p_partkey % 900 as bigint) as age,
       case when p_size = 1 then null else p_type end as category,
       cast(p_size * 60 + p_partkey % 60 as bigint) as length,
       case when p_size between 2 and 3 then null
            else cast((p_partkey * 7919) % 100003 as bigint) end as views,
       cast(p_partkey % 51 as double) / 10 as rating,
       cast(p_partkey * 31 % 4099 as bigint) as ratingCount,
       cast(p_partkey * 17 % 2003 as bigint) as commentCount
from {part}
"""

RELATED_FX = """
select case when a.l_tax = 0.0 then null
            when a.l_tax = 0.08 then 'x' || cast(a.l_partkey as string)
            else 'v' || cast(a.l_partkey as string) end as srcVideoId,
       case when b.l_discount = 0.1 then null
            when b.l_discount = 0.0 then 'x' || cast(b.l_partkey as string)
            else 'v' || cast(b.l_partkey as string) end as dstVideoId
from {lineitem} a join {lineitem} b
  on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1
"""

_RAW_LINES_FX = """
with linked as (
  select p.p_partkey, p.p_brand, p.p_type, p.p_size,
         coalesce(n.lo, p.p_partkey) as lo, coalesce(n.hi, p.p_partkey) as hi
  from {{part}} p left join (
    select a.l_partkey as k, min(b.l_partkey) as lo, max(b.l_partkey) as hi
    from {{lineitem}} a join {{lineitem}} b
      on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1
    group by a.l_partkey) n on p.p_partkey = n.k)
select 1 as batch, p_partkey as line_no, case p_partkey % 10
  when 0 then 'v' || cast(p_partkey as string)
  when 1 then '"v' || cast(p_partkey as string) || '{TAB}' || p_brand || '{TAB}12{TAB}' || p_type
              || '{TAB}60{TAB}100{TAB}4.5{TAB}7{TAB}3{TAB}v1{TAB}v2"'
  when 2 then '{BOM}"v' || cast(p_partkey as string) || '"{TAB}{NBSP}' || p_brand || ' {TAB}12{TAB}' || p_type
              || '{TAB}60{TAB}100{TAB}4.5{TAB}7{TAB}3{TAB}"v3"{TAB}{TAB} v4 '
  when 3 then 'v' || cast(p_partkey as string)
              || '{TAB}"a ""b"" c"{TAB}12{TAB}People & Blogs{TAB}60{TAB}100{TAB}4.5{TAB}7{TAB}3'
  when 4 then 'v' || cast(p_partkey as string) || '{TAB}' || p_brand || '{BAD}{TAB}12.7{TAB}' || p_type
              || '{TAB}60{TAB}n/a{TAB}4.5{TAB}7{TAB}3{TAB}v5'
  when 5 then '  '
  when 6 then '""'
  when 7 then ''
  else 'v' || cast(p_partkey as string) || '{TAB}' || p_brand || '{TAB}' || cast(p_partkey % 900 as string)
       || '{TAB}' || p_type || '{TAB}60{TAB}' || cast(p_partkey * 13 as string) || '{TAB}4.5{TAB}7{TAB}3{TAB}v'
       || cast(lo as string) || '{TAB}v' || cast(hi as string)
  end as value
from linked
union all
select 2, p_partkey, 'v' || cast(p_partkey as string) || '{TAB}{TAB}13{TAB}{TAB}61{TAB}999{TAB}3.5{TAB}8{TAB}4{TAB}v'
       || cast(hi as string)
from linked where p_size > 45
"""
RAW_LINES_FX = _RAW_LINES_FX.format(TAB=TAB, BOM=BOM, NBSP=NBSP, BAD=BAD)

FIXTURES = {"videos_fx": VIDEOS_FX, "related_fx": RELATED_FX, "raw_lines_fx": RAW_LINES_FX}


def duck(name: str) -> str:
    """Fixture SQL for DuckDB, where ``part``/``lineitem`` are views."""
    return FIXTURES[name].format(part="part", lineitem="lineitem")


def with_fixtures(body: str, *names: str) -> str:
    """DuckDB SQL ``with <fixtures> <body>``."""
    ctes = ",\n".join(f"{n} as ({duck(n)})" for n in names)
    return f"with {ctes}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spark_fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = FIXTURES[name]
    args = {}
    if "{part}" in text:
        args["part"] = table(spark, sf_dir, "part")
    if "{lineitem}" in text:
        args["lineitem"] = table(spark, sf_dir, "lineitem")
    return spark.sql(text, **args)


def videos_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_fixture(spark, sf_dir, "videos_fx")


def related_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_fixture(spark, sf_dir, "related_fx")


def raw_lines_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_fixture(spark, sf_dir, "raw_lines_fx")
