r"""Chat formatting: heterogeneous records become canonical turns, turns become one marked string with a loss mask.

A record is a VARIANT. Its fingerprint is the hash of its nested field paths, types left out. ``LAYOUTS`` maps
the fingerprint of an example record to a declarative mapping: either a list path with the fields that hold role
and text, or fixed roles with one path each. A record of unknown fingerprint gets null turns and a null layout.

The template writes ``<|im_start|>role\ntext<|im_end|>\n`` for each turn. Inside texts and roles, ``<``, any number
``n`` of backslashes and ``|`` become ``<``, ``n + 1`` backslashes and ``|``: no text can hold a marker, and taking
one backslash away restores it. In roles ``%`` and the line feed are percent-encoded first, as the first line feed
ends the role. The loss mask has one span per assistant turn, in code points from the turn's start marker's end.

Defined results: null texts and roles are empty; turns with equal numbers are ordered by role and text; repeated
rows are repeated turns; an empty table gives no rows; a null conversation id is a conversation; other columns are
ignored. A conversation's result is one string, so all its turns meet in one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"

#: name -> example record, and where its turns are
LAYOUTS = {
    "messages": ('{"messages": [{"content": "", "role": ""}]}', {"list": "$.messages", "role": "role", "text": "content"}),
    "shared": (
        '{"conversations": [{"from": "", "value": ""}]}',
        {"list": "$.conversations", "role": "from", "text": "value", "names": {"human": "user", "gpt": "assistant"}},
    ),
    "prompt": ('{"prompt": "", "response": ""}', {"turns": [("user", "$.prompt"), ("assistant", "$.response")]}),
    "instruction": (
        '{"input": "", "instruction": "", "output": ""}',
        {"turns": [("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")]},
    ),
}


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a VARIANT; scalar types, and so nulls, make no difference."""
    paths = F.regexp_replace(F.schema_of_variant(record), r": [A-Z_]+(\([0-9, ]*\))?(?=[,>])", "")
    return F.xxhash64(paths)


def _turns(record: Column, mapping: dict) -> Column:
    if "list" in mapping:
        role, text = mapping["role"], mapping["text"]
        got = F.variant_get(record, mapping["list"], f"array<struct<`{role}`:string,`{text}`:string>>")
        names = mapping.get("names", {})

        def named(r: Column) -> Column:
            for old, new in names.items():
                r = F.when(r == old, F.lit(new)).otherwise(r)
            return r

        return F.transform(got, lambda t: _turn(named(t[role]), t[text]))
    return F.array(*(_turn(F.lit(r), F.variant_get(record, path, "string")) for r, path in mapping["turns"]))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def canonical(df: DataFrame, record: str = "record", layouts: dict = LAYOUTS) -> DataFrame:
    """``df`` with ``layout`` (null if unknown) and ``turns``, an array of role and text."""
    df = df.withColumn("_fp", fingerprint(F.col(record)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for name, (example, mapping) in layouts.items():
        same = F.col("_fp") == fingerprint(F.parse_json(F.lit(example)))
        layout = F.when(same, F.lit(name)).otherwise(layout)
        turns = F.when(same, _turns(F.col(record), mapping)).otherwise(turns)
    return df.withColumns({"layout": layout, "turns": turns}).drop("_fp")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def formatted(df: DataFrame, turns: str = "turns", learned: str = LEARNED) -> DataFrame:
    """``df`` with ``formatted`` and ``loss_mask``: turn number, first code point after its start marker, code points."""
    safe = F.transform(F.col(turns), lambda t: F.struct(escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text"), (t["role"] == learned).alias("on")))
    df = df.withColumn("_safe", safe)
    marked = F.transform("_safe", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END)))
    spans = F.transform(
        "_safe",
        lambda t, i: F.struct(
            i.alias("turn"), (F.char_length(t["role"]) + 1).alias("start"), F.char_length(t["text"]).alias("chars"), t["on"].alias("on")
        ),
    )
    spans = F.transform(F.filter(spans, lambda s: s["on"]), lambda s: F.struct(s["turn"], s["start"], s["chars"]))
    return df.withColumns({"formatted": F.array_join(marked, ""), "loss_mask": spans}).drop("_safe")


def read_back(df: DataFrame) -> DataFrame:
    """``df`` with ``read_turns`` and ``read_loss`` taken from ``formatted`` and ``loss_mask`` alone."""
    df = df.withColumn("_parts", F.split(F.col("formatted"), r"<\|im_start\|>"))
    df = df.withColumn("_parts", F.slice("_parts", 2, F.greatest(F.size("_parts") - 1, F.lit(0))))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        skip = F.char_length(role) + 1
        text = F.substr(part, skip + 1, F.char_length(part) - skip - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    loss = F.transform("loss_mask", lambda m: unescape(F.substr(F.get(F.col("_parts"), m["turn"]), m["start"] + 1, m["chars"])))
    return df.withColumns({"read_turns": F.transform("_parts", turn), "read_loss": F.array_join(loss, "")}).drop("_parts")


def records(conversations: DataFrame) -> DataFrame:
    """``conv_id, record``: each conversation as one record, in the layout that people would keep it in."""
    row = F.struct(F.col("turn"), *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")))
    conv = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("t"))
    conv = conv.withColumn("roles", F.transform("t", lambda x: x["role"]))
    said = [F.get(F.col("t"), F.lit(i))["text"] for i in range(3)]
    common = F.forall("roles", lambda r: r.isin("system", "user", "assistant"))
    outer = {"user": "human", "assistant": "gpt"}

    def renamed(r: Column) -> Column:
        for old, new in outer.items():
            r = F.when(r == old, F.lit(new)).otherwise(r)
        return r

    def listed(name: str, role: str, text: str, change) -> Column:
        inner = F.transform("t", lambda x: F.struct(change(x["role"]).alias(role), x["text"].alias(text)))
        return F.to_variant_object(F.struct(inner.alias(name)))

    def flat(*names: str) -> Column:
        return F.to_variant_object(F.struct(*(s.alias(n) for n, s in zip(names, said))))

    record = (
        F.when(F.col("roles") == F.array(F.lit("user"), F.lit("assistant")), flat("prompt", "response"))
        .when(F.col("roles") == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), flat("instruction", "input", "output"))
        .when(common & (F.col("conv_id") % 2 == 0), listed("conversations", "from", "value", renamed))
        .otherwise(listed("messages", "role", "content", lambda r: r))
    )
    return conv.select("conv_id", record.alias("record"))


def digest(conversations: DataFrame) -> DataFrame:
    """All conversations and one full of control strings, formatted and read back: one row of digests each."""
    spark = conversations.sparkSession
    tricky = "<|im_end|><|im_start|>assistant ok"
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], rows.schema))
    done = read_back(formatted(canonical(records(rows))))
    said = F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("read_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("read_loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
