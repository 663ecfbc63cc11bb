"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from vidgraph.functions.text import (  # noqa: F401
    clean_cell,
    clean_id,
    py_strip,
    split_fields,
    strip_outer_quotes,
)
from vidgraph.functions.convert import finite_double, to_float, to_integer  # noqa: F401
