"""Chat formatting by schema fingerprints.

A record is a VARIANT of any layout.  Of the nested field paths of the known
layouts that it holds, those of one layout are hashed; the first layout whose
own hash this equals selects a declarative mapping that turns the record into
canonical (role, text) turns.  Other fields don't matter, also those of other
layouts: lists come before single fields, fields before turn rows, within these
the order of the tables below, and of one layout the form with more fields.  A field
that holds a list of messages gives their turns; a text given as a list of parts is
its text parts, one a line (parts without text give nothing); of several fields that
make one text the empty ones add no line.  The records of one conversation are joined in the order of ``seq``; the template then marks turns
and escapes control strings inside roles and texts.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn, then
``<|endoftext|>``.  Escaping puts one backslash after the first character of
every control string, also of one that already has backslashes there, so it is
undone by taking one away.  ``loss_spans`` are the places (code points) of all
assistant texts in the formatted string.

Defined cases: null roles and texts are empty; a list holds what one of its
elements holds; a record that matches no layout
gives no turn and is counted in ``n_unknown``; conversations without turns stay;
equal ``seq`` are ordered by position, role and text; repeated records count each
time; a record with a null ``conv_id`` is a conversation of its own.  A conversation
is one output string, so its turns meet in one row (very long texts are kept whole, up
to Spark's 2 GB for one string).  Other columns are ignored, also those named like an
added one; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Layouts (field paths to roles), role names, control strings.
LIST_LAYOUTS = {
    "messages": ("messages", "role", "content"),
    "nested messages": ("data.messages", "role", "content"),
    "conversations": ("conversations", "from", "value"),
    "turns": ("turns", "role", "text"),
}
ROW_LAYOUTS = {"turn row": ("role", "text"), "message row": ("role", "content")}
# Layout: fields in turn order.
FIELD_LAYOUTS = {
    "prompt and response": [("user", "prompt"), ("assistant", "response")],
    "prompt and completion": [("user", "prompt"), ("assistant", "completion")],
    "question and answer": [("user", "question"), ("assistant", "answer")],
    "instruction with input": [("user", "instruction+input"), ("assistant", "output")],
    "instruction": [("user", "instruction"), ("assistant", "output")],
    "input and output": [("user", "input"), ("assistant", "output")],
}
# A system turn of its own that lists and fields may come with.
SYSTEM_FIELDS = ["system", "system_prompt"]
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURN, SEP, END, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>"
CONTROL_BODIES = r"\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?SYS>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)(" + CONTROL_BODIES + ")", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)(" + CONTROL_BODIES + ")", "$1$2$3")


def _mappings() -> list[tuple[str, list[str], object]]:
    """(layout, its field paths, how to get an array of turns from a record), in
    the order of precedence."""
    turn = "array<struct<role:string,text:string>>"
    found: list[tuple[str, list[str], object]] = []

    def listed(name, role, text):
        return lambda v: F.transform(_elements(v, name), lambda e: F.struct(
            _text(e, role).alias("role"), _text(e, text).alias("text"))).cast(turn)

    def fields(parts):
        return lambda v: F.concat(*[_field_turns(v, role, path).cast(turn) for role, path in parts])

    systems = [[], *[[x] for x in SYSTEM_FIELDS]]
    for layout, (name, role, text) in LIST_LAYOUTS.items():
        paths, build = [f"{name}[].{role}", f"{name}[].{text}"], listed(name, role, text)
        for system in reversed(systems):
            first = [fields([("system", x)]) for x in system]
            found.append((layout, [*system, *paths], lambda v, b=build, f=first: F.concat(*[x(v) for x in f], b(v))))
    for layout, parts in FIELD_LAYOUTS.items():
        for system in reversed(systems):
            held = [*[("system", x) for x in system], *parts]
            found.append((layout, [x for _, p in held for x in p.split("+")], fields(held)))
    for layout, (role, text) in ROW_LAYOUTS.items():
        found.append((layout, [role, text], lambda v, r=role, t=text: F.array(
            F.struct(_text(v, r).alias("role"), _text(v, t).alias("text"))).cast(turn)))
    return found


def _elements(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "array<variant>")


def _is_string(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def _text(v: Column, path: str) -> Column:
    """A field as text; of a list of parts the texts, one a line."""
    def part(p):
        return F.when(_is_string(p), F.try_variant_get(p, "$", "string")).otherwise(F.try_variant_get(p, "$.text", "string"))

    joined = F.array_join(F.array_compact(F.transform(_elements(v, path), part)), "\n")
    return F.coalesce(joined, F.try_variant_get(v, f"$.{path}", "string"))


def _field_turns(v: Column, role: str, path: str) -> Column:
    """The turn of a field (``a+b``: of several, empty ones left out), or the turns of
    the messages that it lists."""
    texts = F.filter(F.array(*[F.coalesce(_text(v, p), F.lit("")) for p in path.split("+")]), lambda t: t != "")
    one = F.array(F.struct(F.lit(role).alias("role"), F.array_join(texts, "\n").alias("text")))
    if "+" in path:
        return one
    messages = _elements(v, path)
    listed = F.transform(messages, lambda e: F.struct(
        F.coalesce(_text(e, "role"), F.lit(role)).alias("role"), F.coalesce(_text(e, "content"), F.lit("")).alias("text")))
    holds = F.exists(messages, lambda e: F.try_variant_get(e, "$.content", "variant").isNotNull())
    return F.when(holds, listed).otherwise(one)


MAPPINGS = _mappings()
PATHS = sorted({p for _, paths, _ in MAPPINGS for p in paths})


def _holds(record: Column, path: str) -> Column:
    """Null values count as held; a list holds what one of its elements holds."""
    name, _, field = path.rpartition("[].")
    if name:
        return F.exists(_elements(record, name), lambda e: F.try_variant_get(e, f"$.{field}", "variant").isNotNull())
    return F.try_variant_get(record, f"$.{field}", "variant").isNotNull()


def held_paths(record: Column) -> Column:
    """The known nested field paths that a record holds."""
    return F.array_compact(F.array(*[F.when(_holds(record, p), F.lit(p)) for p in PATHS]))


def fingerprint(held: Column, paths: list[str]) -> Column:
    """Hash of those of one layout's field paths that are held."""
    return F.xxhash64(F.array_join(F.array_intersect(F.array(*[F.lit(p) for p in sorted(paths)]), held), "\n"))


def canonical_turns(records: DataFrame) -> DataFrame:
    """``conv_id, alone, seq, layout, pos, role, text`` from ``conv_id, seq, record``; a
    record without turns gives one row whose ``pos`` is null.  ``alone`` tells the
    records without a ``conv_id`` apart."""
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    rows = records.select("conv_id", alone.alias("alone"), "seq", "record", held_paths(F.col("record")).alias("held"))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for name, paths, build in reversed(MAPPINGS):
        same = fingerprint(F.col("held"), paths) == F.xxhash64(F.lit("\n".join(sorted(paths))))
        layout = F.when(same, F.lit(name)).otherwise(layout)
        turns = F.when(same, build(F.col("record"))).otherwise(turns)
    rows = rows.select("conv_id", "alone", "seq", layout.alias("layout"), F.posexplode_outer(turns).alias("pos", "turn"))
    role = F.coalesce("turn.role", F.lit(""))
    for old, new in ROLE_NAMES.items():  # names of one layout only; elsewhere a role is what it says
        role = F.when((F.col("layout") == "conversations") & (role == old), new).otherwise(role)
    return rows.select("conv_id", "alone", "seq", "layout", "pos", role.alias("role"),
                       F.coalesce("turn.text", F.lit("")).alias("text"))


def format_chats(records: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans`` (array of
    ``start, length``), ``n_unknown``."""
    turns = canonical_turns(records)
    some = F.col("pos").isNotNull()
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SEP))
    turns = turns.withColumn("head", F.when(some, head).otherwise(""))
    turns = turns.withColumn("body", F.when(some, escape(F.col("text"))).otherwise(""))
    turns = turns.withColumn("size", F.when(
        some, F.length("head") + F.length("body") + len(END)).otherwise(0).cast("bigint"))
    order = ["seq", "pos", "role", "text"]
    upto = Window.partitionBy("conv_id", "alone").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumn("end", F.sum("size").over(upto)).withColumn("n", F.count(F.lit(1)).over(upto))
    span = F.struct((F.col("end") - len(END) - F.length("body")).alias("start"),
                    F.length("body").cast("bigint").alias("length"))
    loss = F.when(some & (F.col("role") == "assistant"), span)
    piece = F.when(some, F.concat("head", "body", F.lit(END))).otherwise("")
    chats = turns.groupBy("conv_id", "alone").agg(
        F.sort_array(F.collect_list(F.struct("n", piece.alias("piece")))).alias("pieces"),
        F.sort_array(F.collect_list(loss)).alias("loss_spans"),
        F.sum(F.col("layout").isNull().cast("bigint")).alias("n_unknown"))
    return chats.select("conv_id", F.concat(F.array_join("pieces.piece", ""), F.lit(STOP)).alias("formatted"),
                        "loss_spans", "n_unknown")


def parse_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted string, unescaped."""
    parts = F.split(formatted, r"<\|im_end\|>")
    parts = F.filter(parts, lambda p: p.startswith(TURN))
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), SEP, 1)).alias("role"),
        unescape(F.substr(p, F.locate(SEP, p) + len(SEP))).alias("text")))


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
