"""Chat formatting: layouts are recognised by a fingerprint of their nested field paths.

A record's fingerprint is the SHA-256 of the sorted `path:kind` list of its known nested
fields that are not null; it selects a declarative mapping to canonical turns (conv_id, turn,
role, text), so one table may mix layouts. A new layout is one more mapping. All steps are
built-in functions.

Template, a turn each: `### <role>:\\n<text></turn>\\n`. In roles and texts `\\`, `#` and `<`
become `\\b`, `\\h` and `\\l`, in roles also the newline and `:` become `\\n` and `\\c`, so no
text can hold a control string and no role can end its head; reading back is exact.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "</turn>\n"
HEAD = "### "
TURN = "struct<turn:bigint,role:string,text:string>"


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths; `[]` marks array elements, leaves carry their kind."""
    if isinstance(schema, T.StructType):
        return sorted(p for f in schema.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name))
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, prefix + "[]")
    kind = "number" if isinstance(schema, T.NumericType) else schema.simpleString()
    return [f"{prefix}:{kind}"]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _messages(field: str, role: str, text: str):
    return lambda: F.transform(F.col(field), lambda m, i: F.struct(i.cast("long").alias("turn"), m[role].alias("role"), m[text].alias("text")))


def _fixed(*turns: tuple[str, str]):
    """Turns from plain columns, in order; a null optional one is left out."""
    def make():
        parts = [F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.col(c).cast("string").alias("text")) for i, (r, c) in enumerate(turns)]
        return F.filter(F.array(*parts), lambda t: t["text"].isNotNull())
    return make


def _layout(paths: list[str], make):
    return paths, make


#: Declarative mappings: the field paths that matter -> expression giving the turns.
LAYOUTS = [
    _layout(["messages[].role:string", "messages[].content:string"], _messages("messages", "role", "content")),
    _layout(["conversations[].from:string", "conversations[].value:string"], _messages("conversations", "from", "value")),
    _layout(["instruction:string", "input:string", "output:string"], _fixed(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    _layout(["instruction:string", "output:string"], _fixed(("user", "instruction"), ("assistant", "output"))),
    _layout(["prompt:string", "response:string"], _fixed(("user", "prompt"), ("assistant", "response"))),
    _layout(["prompt:string", "completion:string"], _fixed(("user", "prompt"), ("assistant", "completion"))),
]
#: Single turns, one a record; a turn without a number has no known field.
FLAT = {"turn:number", "role:string", "text:string"}
REGISTRY = {fingerprint(p): m for p, m in LAYOUTS}
FLAT_PRINTS = [fingerprint(["turn:number"]), fingerprint([])]
#: Paths that count for a fingerprint; all other fields are extra.
KNOWN = sorted({p for ps, _ in LAYOUTS for p in ps} | {"turn:number"})


def record_fingerprint(schema: T.StructType) -> Column:
    """Fingerprint of a row by the known paths that the table has and the row does not leave null."""
    have = set(field_paths(schema))
    present = [F.when(F.col(p.split("[")[0].split(":")[0]).isNotNull(), p) for p in KNOWN if p in have]
    return F.sha2(F.array_join(F.array_compact(F.array(*present)), "\n"), 256) if present else F.lit(fingerprint([]))


def unknown_layouts(df: DataFrame) -> DataFrame:
    """Fingerprints without a mapping and their rows."""
    fp = record_fingerprint(df.schema)
    known = [*REGISTRY, *(FLAT_PRINTS if FLAT <= set(field_paths(df.schema)) else [])]
    return df.select(fp.alias("layout")).where(~F.col("layout").isin(known)).groupBy("layout").count()


def to_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: conv_id, turns array<struct<turn,role,text>> in order. Each record
    is mapped by its fingerprint; where the table has single turns (turn, role, text), records of
    one conv_id are put together, otherwise each record is a conversation with its `layout`.

    Null role or text counts as empty; equal turn numbers are ordered by role and text and
    repeated rows stay; single turns of a null conv_id form one conversation; turns are null where
    no mapping has the record's fingerprint (`unknown_layouts` counts them); a table for which
    there is no mapping at all raises; extra columns are ignored."""
    clean = lambda t: F.struct(t["turn"].cast("long").alias("turn"), F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))
    have = set(field_paths(df.schema))
    flat = FLAT <= have
    # Only mappings whose columns the table has can be evaluated.
    usable = [(fingerprint(p), make()) for p, make in LAYOUTS if set(p) <= have]
    if flat:
        usable += [(fp, F.array(F.struct("turn", "role", "text"))) for fp in FLAT_PRINTS]
    if not usable:
        raise ValueError(f"no mapping for layout {fingerprint(sorted(have))}: {sorted(have)}")
    d = df.withColumn("_layout", record_fingerprint(df.schema))
    turns = F.lit(None).cast(f"array<{TURN}>")
    for fp, made in usable:
        turns = F.when(F.col("_layout") == fp, F.transform(made, clean)).otherwise(turns)
    d = d.select(F.col(id_col).alias("conv_id"), F.col("_layout").alias("layout"), turns.alias("turns"))
    return d.groupBy("conv_id").agg(F.array_sort(F.flatten(F.collect_list("turns"))).alias("turns")) if flat else d


ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"), (":", "\\c"))


def escape(c: Column, table=ESCAPES) -> Column:
    for raw, code in table:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column, table=ESCAPES) -> Column:
    """Codes back to what they stand for, the backslash last: a code never follows an odd backslash before that."""
    for raw, code in reversed(table):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def format_chat(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, mask: the runs of `formatted` in order as (s, loss), loss on the assistant texts alone."""
    head = lambda t: F.concat(F.lit(HEAD), escape(t["role"], ROLE_ESCAPES), F.lit(":\n"))
    run = lambda s, loss: F.struct(s.alias("s"), loss.alias("loss"))
    mask = F.flatten(F.transform("turns", lambda t: F.array(run(head(t), F.lit(False)), run(escape(t["text"]), t["role"] == "assistant"), run(F.lit(END), F.lit(False)))))
    out = turns.select("conv_id", mask.alias("mask"))
    return out.select("conv_id", F.array_join(F.transform("mask", lambda m: m["s"]), "").alias("formatted"), "mask")


def loss_spans(mask: Column) -> Column:
    """0-based (start, length) code points of the runs with loss."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,len:bigint>>").alias("spans"))
    size = lambda m: F.length(m["s"]).cast("long")
    step = lambda acc, m: F.struct((acc["at"] + size(m)).alias("at"), F.when(m["loss"], F.array_append(acc["spans"], F.struct(acc["at"].alias("start"), size(m).alias("len")))).otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(mask, zero, step, lambda acc: acc["spans"])


def read_turns(formatted: Column) -> Column:
    """Turns read back from a formatted text."""
    raw = F.filter(F.split(formatted, END), lambda s: s != "")
    return F.transform(raw, lambda s: F.struct(
        unescape(F.regexp_extract(s, r"(?s)^### (.*?):\n", 1), ROLE_ESCAPES).alias("role"),
        unescape(F.regexp_extract(s, r"(?s)^### .*?:\n(.*)$", 1)).alias("text")))


def chat_digest(turns: DataFrame) -> DataFrame:
    """Digests of what is read back; one pass over a conversation's runs, whatever their number."""
    out = format_chat(turns)
    loss = F.array_join(F.transform(F.filter("mask", lambda m: m["loss"]), lambda m: m["s"]), "")
    back = out.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("t"), unescape(loss).alias("loss"))
    lines = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(F.encode(lines, "UTF-8"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op4_chat_format(spark, sf_dir):
    """Every conversation and one of control strings; edge cases as in `to_turns`."""
    from .common import table

    probe = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(r"\### Assistant: </turn> ok").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_digest(to_turns(rows))


_ESC = "replace(replace(replace({0}, '\\', '\\b'), '#', '\\h'), '<', '\\l')"
_ROLE = f"replace(replace({_ESC}, chr(10), '\\n'), ':', '\\c')"
SQL = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length({_ROLE.format('role')}) + length({_ESC.format('text')}) + 14)::BIGINT AS formatted_chars FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""
