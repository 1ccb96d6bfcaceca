"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

Records arrive in different layouts (message lists, prompt and response,
instruction with input and output), as JSON text or as typed columns.
``fingerprints`` hashes the nested field paths of a JSON record row by row,
``fingerprint_of_type`` those of a typed column; either hash selects the
mapping in ``MAPPINGS`` that reads the turns (``canonical_turns``,
``typed_turns``). ``turns_to_records`` brings a table with one row per turn
into a typed record.
``format_turns`` writes one training text per conversation with control
strings escaped reversibly and a loss mask over the assistant texts;
``read_back`` recovers turns and mask from that text alone.

Everything is DataFrame expressions; no Python runs on executors.

Defined results: a null text, role or part of a record is empty; a record
whose layout is not known keeps a null ``turns`` and is not formatted; a
record without turns gives an empty text; turns are ordered by turn number
(nulls first), then role and text, so repeated rows and ties have one order.
An assistant text takes part in the loss exactly once. A conversation is one
output row, so all its turns meet in one row by definition of the result. A
text may be as long as a row of Spark allows (2 GB for a conversation, its JSON
and its formatted text each). An empty table gives no rows; only the four columns
of a turn are read, so others may have any name.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"

#: Opening and closing marks of the roles that have marks of their own.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s>", "</s>"),
}
#: Any other role: its escaped name stands inside the opening mark.
OTHER_OPEN, OTHER_NAMED, OTHER_CLOSE = "[ROLE ", "] ", " [/ROLE]"
#: A control string is recognised by its first character and what follows it.
_SQUARE = r"\[(?=/?INST\]|/?ROLE[ \]])"
_ANGLE = r"<(?=/?s>|</?SYS>>)"


def paths_of(kind: str) -> tuple[str, ...]:
    """Nested field paths of a DDL type, sorted; ``[]`` marks list items."""

    def walk(t: T.DataType, at: str) -> list[str]:
        if isinstance(t, T.StructType):
            return [p for f in t.fields for p in walk(f.dataType, f"{at}.{f.name}" if at else f.name)]
        if isinstance(t, T.ArrayType):
            return walk(t.elementType, at + "[]")
        return [at]

    return tuple(sorted(walk(T._parse_datatype_string(kind), "")))


def _messages(list_field: str, role: str, text: str):
    def read(r: Column) -> Column:
        return F.transform(r[list_field], lambda m: F.struct(m[role].alias("role"), m[text].alias("text")))

    return read


def _pairs(*parts: tuple[str, tuple[str, ...]]):
    """Turns made of named fields; several fields of one turn are joined by a blank line, empty ones left out."""

    def read(r: Column) -> Column:
        texts = [(role, F.array_join(F.filter(F.array(*[r[f] for f in fields]), lambda x: x.isNotNull() & (x != "")), "\n\n")) for role, fields in parts]
        turns = F.array(*[F.struct(F.lit(role).alias("role"), text.alias("text")) for role, text in texts])
        return F.filter(turns, lambda t: (t["role"] != "system") | (t["text"] != ""))

    return read


#: Layouts: the record's DDL, and how its turns are read.
MAPPINGS = {
    "messages": ("struct<messages:array<struct<role:string,content:string>>>", _messages("messages", "role", "content")),
    "from_value": ("struct<conversations:array<struct<from:string,value:string>>>", _messages("conversations", "from", "value")),
    "turns": ("struct<turns:array<struct<role:string,text:string>>>", _messages("turns", "role", "text")),
    "prompt_response": ("struct<prompt:string,response:string>", _pairs(("user", ("prompt",)), ("assistant", ("response",)))),
    "prompt_completion": ("struct<prompt:string,completion:string>", _pairs(("user", ("prompt",)), ("assistant", ("completion",)))),
    "system_prompt_response": ("struct<system:string,prompt:string,response:string>", _pairs(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    "instruction": ("struct<instruction:string,output:string>", _pairs(("user", ("instruction",)), ("assistant", ("output",)))),
    "instruction_input": ("struct<instruction:string,input:string,output:string>", _pairs(("user", ("instruction", "input")), ("assistant", ("output",)))),
    "question_answer": ("struct<question:string,answer:string>", _pairs(("user", ("question",)), ("assistant", ("answer",)))),
}

#: Role names that mean the same as a canonical one.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _hash_of_paths(paths: Column) -> Column:
    return F.xxhash64(F.array_join(F.array_sort(paths), "\n"))


def fingerprints(record: Column) -> Column:
    """Hash of a JSON record's nested field paths, whatever their order and values; null if it is no JSON.

    Paths reach as deep as the known layouts: fields of the record, and of
    the objects in its lists.
    """
    v = F.try_parse_json(record)
    top = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))

    def below(e: Column) -> Column:
        items = F.try_variant_get(e["value"], "$", "array<map<string,variant>>")
        keys = F.array_distinct(F.flatten(F.transform(F.coalesce(items, F.array()), lambda m: F.coalesce(F.map_keys(m), F.array()))))
        inner = F.transform(keys, lambda k: F.concat(e["key"], F.lit("[]."), k))
        return F.when(F.size(inner) > 0, inner).otherwise(F.array(e["key"]))

    return F.when(top.isNotNull(), _hash_of_paths(F.flatten(F.transform(top, below))))


def canonical_turns(records: DataFrame, record: str = "record", mappings: dict | None = None) -> DataFrame:
    """Add ``layout`` and ``turns`` to rows with a JSON ``record``.

    A list layout whose list is empty or missing gives no turns. A field may be
    null. The fingerprint decides the layout, so extra fields make a layout unknown.
    """
    mappings = mappings or MAPPINGS
    df = records.withColumn("fingerprint", fingerprints(F.col(record)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for name, (ddl, read) in mappings.items():
        paths = paths_of(ddl)
        known = [_hash_of_paths(F.array(*map(F.lit, paths)))]
        if any("[]" in p for p in paths):  # an empty list has no items with fields
            known.append(_hash_of_paths(F.array(*[F.lit(p) for p in sorted({p.split("[]")[0] for p in paths})])))
        hit = F.col("fingerprint").isin(*known)
        layout = F.when(hit, F.lit(name)).otherwise(layout)
        turns = F.when(hit, F.coalesce(read(F.from_json(F.col(record), ddl, {"maxStringLen": "2147483647"})), F.array().cast(TURNS)).cast(TURNS)).otherwise(turns)
    return df.withColumns({"layout": layout, "turns": _clean(turns)})


def _clean(turns: Column) -> Column:
    named = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])

    def turn(t: Column) -> Column:
        role = F.coalesce(t["role"], F.lit(""))
        return F.struct(F.coalesce(named[role], role).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))

    return F.transform(turns, turn)


def fingerprint_of_type(kind: str) -> str:
    """Hash of the nested field paths of a typed record."""
    return hashlib.sha256("\n".join(paths_of(kind)).encode()).hexdigest()


def typed_turns(records: DataFrame, record: str = "record", mappings: dict | None = None) -> DataFrame:
    """Add ``layout`` and ``turns`` to rows with a struct ``record``; the type's fingerprint decides the layout."""
    mappings = mappings or MAPPINGS
    known = {fingerprint_of_type(ddl): (name, read) for name, (ddl, read) in mappings.items()}
    name, read = known.get(fingerprint_of_type(records.schema[record].dataType.simpleString()), (None, None))
    turns = F.coalesce(read(F.col(record)), F.array().cast(TURNS)).cast(TURNS) if read else F.lit(None).cast(TURNS)
    return records.withColumns({"layout": F.lit(name).cast("string"), "turns": _clean(turns)})


def turns_to_records(rows: DataFrame) -> DataFrame:
    """One typed record in the ``turns`` layout for each ``conv_id`` of a (conv_id, turn, role, text) table."""
    part = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (
        rows.select("conv_id", part.alias("t"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("t"))
        .select("conv_id", F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")).alias("record"))
    )


def escape(text: Column) -> Column:
    """No control string is left: ``~`` becomes ``~0`` and the first character of a control string ``~1`` or ``~2``."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "~", "~0"), _SQUARE, "~1"), _ANGLE, "~2")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~2"), F.lit("<")), F.lit("~1"), F.lit("[")), F.lit("~0"), F.lit("~"))


def _open(role: Column) -> Column:
    out = F.concat(F.lit(OTHER_OPEN), F.replace(escape(role), F.lit("]"), F.lit("~3")), F.lit(OTHER_NAMED))
    for name, (mark, _) in MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def _close(role: Column) -> Column:
    out = F.lit(OTHER_CLOSE)
    for name, (_, mark) in MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Add ``formatted`` (the training text) and ``loss`` (start and length, in characters, of each assistant text)."""
    parts = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), _open(t["role"]).alias("open"), escape(t["text"]).alias("body"), _close(t["role"]).alias("close")))
    df = df.withColumn("_parts", parts)
    starts = running_sums(F.transform("_parts", lambda p: (F.length(p["open"]) + F.length(p["body"]) + F.length(p["close"])).cast("long")))
    spans = F.zip_with(
        "_parts",
        starts,
        lambda p, at: F.struct(p["role"].alias("role"), (at + F.length(p["open"])).alias("start"), F.length(p["body"]).cast("long").alias("length")),
    )
    loss = F.transform(F.filter(spans, lambda s: s["role"] == "assistant"), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p["open"], p["body"], p["close"])), "")
    return df.withColumns({"formatted": text, "loss": loss}).drop("_parts")


def running_sums(values: Column, block: int = 256) -> Column:
    """For each item of a bigint array the sum of those before it.

    Appending to an array copies it, so the sums are taken in blocks and the
    blocks' totals summed in turn: far from quadratic on long arrays.
    """

    def sums(xs: Column) -> Column:
        none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(xs, none, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    n = F.size(values)
    blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda b: F.slice(values, b * block + 1, block))).otherwise(F.array().cast("array<array<bigint>>"))
    return F.flatten(F.zip_with(blocks, sums(F.transform(blocks, total)), lambda xs, at: F.transform(sums(xs), lambda x: x + at)))


def read_back(df: DataFrame, formatted: str = "formatted", loss: str = "loss") -> DataFrame:
    """Add ``read_turns`` and ``read_loss`` (assistant texts under the mask), both from the formatted text."""
    ends = "|".join(rf"(?<={m})" for m in (r"<</SYS>>", r" \[/INST\]", r"</s>", r" \[/ROLE\]"))
    parts = F.filter(F.split(F.col(formatted), ends), lambda p: p != "")

    def turn(p: Column) -> Column:
        name = F.regexp_extract(p, r"^\[ROLE ([^\]]*)\] ", 1)
        role = unescape(F.replace(name, F.lit("~3"), F.lit("]")))
        body = p.substr(F.length(name) + F.lit(len(OTHER_OPEN + OTHER_NAMED) + 1), F.length(p) - F.length(name) - F.lit(len(OTHER_OPEN + OTHER_NAMED + OTHER_CLOSE)))
        for known, (a, b) in MARKS.items():
            hit = p.startswith(a)
            role = F.when(hit, F.lit(known)).otherwise(role)
            body = F.when(hit, p.substr(F.lit(len(a) + 1), F.length(p) - F.lit(len(a) + len(b)))).otherwise(body)
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    masked = F.transform(loss, lambda s: unescape(F.col(formatted).substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return df.withColumns({"read_turns": F.transform(parts, turn), "read_loss": masked})


def digests(df: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted conversations, as read back."""
    told = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("read_loss", "")
    return read_back(df).select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """Training texts for a table with one row per turn: conv_id, layout, turns, formatted, loss.

    Each conversation goes as a JSON record through ``canonical_turns``, whose
    fingerprint of the row's own field paths selects the mapping. A record
    beyond the size that Spark parses as a variant has no fingerprint; its
    turns are those of the typed record.
    """
    typed = typed_turns(turns_to_records(rows)).select("conv_id", F.to_json("record").alias("record"), F.col("layout").alias("typed_layout"), F.col("turns").alias("typed_turns"))
    read = canonical_turns(typed)
    read = read.withColumns({"layout": F.coalesce("layout", "typed_layout"), "turns": F.coalesce("turns", "typed_turns")})
    return format_turns(read).select("conv_id", "layout", "turns", "formatted", "loss")
