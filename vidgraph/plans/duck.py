"""DuckDB SQL fragments for the oracles: an independent restatement of the
cleaning and typing rules in another engine (RE2 regular expressions)."""

from __future__ import annotations

from vidgraph.plans import fixtures as fx

# The characters Python's str.strip() removes, as an RE2 class.
WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _nobom(x: str) -> str:
    return rf"regexp_replace({x}, '^\x{{feff}}', '')"


def clean_id(x: str) -> str:
    s = _nobom(strip(f"coalesce({x}, '')"))
    return f"""regexp_replace({s}, '^"+|"+$', '', 'g')"""


def clean_cell(x: str) -> str:
    s = _nobom(strip(f"coalesce({x}, '')"))
    return (f"""(case when length({s}) >= 2 and starts_with({s}, '"') and ends_with({s}, '"') """
            f"""then replace(substr({s}, 2, length({s}) - 2), '""', '"') else {s} end)""")


def to_integer(x: str) -> str:
    s = strip(x)
    return (f"(case when regexp_full_match({s}, '[+-]?[0-9]+') then try_cast({s} as bigint) "
            f"when isfinite(try_cast({s} as double)) then try_cast(trunc(try_cast({s} as double)) as bigint) end)")


def finite_double(x: str) -> str:
    return f"(case when isfinite(try_cast({x} as double)) then try_cast({x} as double) end)"


def to_float(x: str) -> str:
    return finite_double(strip(x))


_COLS = ["videoId", "uploader", "age", "category", "length", "views", "rating", "ratingCount", "commentCount"]

LINES = rf"""
unq as (select batch, line_no,
          case when length(v0) >= 2 and starts_with(v0, '"') and ends_with(v0, '"')
               then substr(v0, 2, length(v0) - 2) else v0 end as line
        from (select batch, line_no, regexp_replace(value, '[\r\n]+$', '') as v0 from raw_lines_fx)),
lines as (select batch, line_no, string_split(line, chr(9)) as f from unq where line <> ''),
vt as (select batch, line_no, {clean_id('f[1]')} as videoId,
       {", ".join(f"{clean_cell(f'f[{i + 1}]')} as {c}" for i, c in enumerate(_COLS) if i > 0)}
       from lines),
rt as (select batch, line_no, srcVideoId, dstVideoId from (
         select batch, line_no, {clean_id('f[1]')} as srcVideoId, {clean_id('d')} as dstVideoId
         from (select batch, line_no, f, unnest(f[10:]) as d from lines)) where dstVideoId <> ''),
gt as (select batch, line_no, nullif(videoId, '') as videoId, nullif(uploader, '') as uploader,
       {to_integer("nullif(age, '')")} as age, nullif(category, '') as category,
       {to_integer("nullif(length, '')")} as length, {to_integer("nullif(views, '')")} as views,
       {to_float("nullif(rating, '')")} as rating, {to_integer("nullif(ratingCount, '')")} as ratingCount,
       {to_integer("nullif(commentCount, '')")} as commentCount
       from vt)
"""


def with_lines(body: str, *extra_fixtures: str) -> str:
    """DuckDB SQL over the parsed raw-lines fixture (CTEs unq, lines, vt, rt, gt)."""
    return fx.with_fixtures("", "raw_lines_fx", *extra_fixtures).rstrip() + ",\n" + LINES.strip() + "\n" + body
