"""Chat formatting: records of many layouts become canonical turns, then one marked string with a loss mask.

A record is a JSON text. The hash of its nested field paths (its schema fingerprint)
selects one declarative mapping, which says where role and text of each turn lie. The
template marks turns; control strings inside roles and texts are escaped by a backslash
after their first character, and backslashes are doubled, so that reading back is exact.
All of it is DataFrame functions.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# Marks of the template, and the other control strings that texts may not hold.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (
    r"(<)(/?s>|</?SYS>>|/?think>|\|(?:im_start|im_sep|im_end|endoftext|startoftext|system|user|assistant|end|eot_id|start_header_id|end_header_id)\|>)"
    r"|(\[)(/?INST\])"
)
# End of fixed values.


@dataclass(frozen=True)
class Mapping:
    """Where the turns of one layout lie.

    ``schema``: the record's type. ``turns``: role and path of each turn, a null or missing
    one is left out. ``array``: path, role field and text field of a list of turns, which
    follow those of ``turns``. ``roles``: other names of roles.
    """

    name: str
    schema: str
    turns: tuple[tuple[str, str], ...] = ()
    array: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()


MAPPINGS = (
    Mapping("messages", "messages ARRAY<STRUCT<content STRING, role STRING>>", array=("messages", "role", "content")),
    Mapping(
        "conversations",
        "conversations ARRAY<STRUCT<`from` STRING, value STRING>>",
        array=("conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Mapping(
        "dialogue",
        "data STRUCT<turns ARRAY<STRUCT<speaker STRING, utterance STRING>>>",
        array=("data.turns", "speaker", "utterance"),
        roles=(("human", "user"), ("bot", "assistant")),
    ),
    Mapping("prompt", "prompt STRING, completion STRING", (("user", "prompt"), ("assistant", "completion"))),
    Mapping("response", "prompt STRING, response STRING", (("user", "prompt"), ("assistant", "response"))),
    Mapping("question", "question STRING, answer STRING", (("user", "question"), ("assistant", "answer"))),
    Mapping(
        "instruction",
        "system STRING, instruction STRING, output STRING",
        (("system", "system"), ("user", "instruction"), ("assistant", "output")),
    ),
    Mapping("task", "instruction STRING, output STRING", (("user", "instruction"), ("assistant", "output"))),
    Mapping(
        "nested",
        "system STRING, messages ARRAY<STRUCT<content STRING, role STRING>>",
        (("system", "system"),),
        ("messages", "role", "content"),
    ),
)


def field_paths(record: Column) -> Column:
    """The nested field names of a JSON text in canonical order, without types; null if it is no JSON."""
    shape = F.schema_of_variant(F.try_parse_json(record))
    # Scalar types go, so a null or a number under a field does not change the paths.
    return F.regexp_replace(shape, r": [A-Z_]+(?:\([0-9,]*\))?(?=[,>])", "")


def fingerprint(record: Column) -> Column:
    """64-bit hash of the nested field paths of a JSON text."""
    paths = field_paths(record)
    return F.when(paths.isNotNull(), F.xxhash64(paths))


def _type(mapping):
    return StructType.fromDDL(mapping.schema)


def _example(kind):
    """A value of a type with every field filled."""
    if isinstance(kind, StructType):
        return F.struct(*[_example(f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return F.array(_example(kind.elementType))
    return F.lit("x")


def _turns(mapping, record):
    """The turns of a record of this layout, as array of (role, text)."""
    parsed = F.from_json(record, _type(mapping))
    names = F.create_map(*[F.lit(x) for pair in mapping.roles for x in pair]) if mapping.roles else None

    def turn(role, text):
        role = F.coalesce(role, F.lit(""))
        if names is not None:
            role = F.coalesce(F.try_element_at(names, role), role)
        return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    parts = []
    if mapping.turns:
        fixed = [F.when(parsed[path].isNotNull(), turn(F.lit(role), parsed[path])) for role, path in mapping.turns]
        parts.append(F.array_compact(F.array(*fixed)))
    if mapping.array:
        path, role, text = mapping.array
        for field in path.split("."):
            parsed = parsed[field]
        parts.append(F.transform(F.array_compact(parsed), lambda t: turn(t[role], t[text])))
    return F.concat(*parts)


def canonical_turns(records: DataFrame, ids="conv_id", record="record", mappings=MAPPINGS) -> DataFrame:
    """(conv_id, layout, turns: array of role and text), one row per record.

    A null role or text in a list counts as empty; a null field of a fixed turn is no turn. A
    record whose fingerprint no mapping has, or that is no JSON (null too), keeps its row with
    layout and turns null. Ids may repeat or be null; an empty table gives an empty table.
    """
    one = records.sparkSession.range(1)
    known = one.select(*[fingerprint(F.to_json(_example(_type(m)))).alias(m.name) for m in mappings]).first()
    marked = records.select(F.col(ids).alias("conv_id"), F.col(record).alias("record")).withColumn("print", fingerprint(F.col("record")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for mapping, own in zip(reversed(mappings), reversed(known)):
        hit = F.col("print") == F.lit(own)
        layout = F.when(hit, F.lit(mapping.name)).otherwise(layout)
        turns = F.when(hit, _turns(mapping, F.col("record"))).otherwise(turns)
    return marked.select("conv_id", layout.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    """Backslashes doubled, control strings broken by a backslash after their first character."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame, trained=("assistant",)) -> DataFrame:
    """(conv_id, layout, formatted, mask) for rows of (conv_id, layout, turns).

    ``mask``: array of (start, length) in code points of ``formatted``, one for the text of each
    turn whose role is in ``trained``, in order. No turns: an empty string and an empty mask; null
    turns: both null.
    """
    spans = "array<struct<start:int,length:int>>"
    parts = turns.withColumn("parts", F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escape(t["role"]), F.lit(SEPARATOR)).alias("head"),
        escape(t["text"]).alias("body"),
        t["role"].isin(*trained).alias("trained"),
    )))

    def advance(done, part):
        start = done["at"] + F.length(part["head"])
        length = F.length(part["body"])
        span = F.array(F.struct(start.alias("start"), length.alias("length"))).cast(spans)
        return F.struct(
            (start + length + F.lit(len(END))).alias("at"),
            F.when(part["trained"], F.concat(done["mask"], span)).otherwise(done["mask"]).alias("mask"),
        )

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("mask"))
    return parts.select(
        "conv_id",
        "layout",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("parts", empty, advance, lambda done: done["mask"]).alias("mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text): the turns of each formatted string, and all text under its mask, unescaped."""
    pieces = F.split("formatted", r"\Q" + END + r"\E", -1)
    turns = F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), _read_turn)
    under = F.transform("mask", lambda m: F.substring(F.col("formatted"), m["start"] + 1, m["length"]))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), unescape(F.array_join(under, "")).alias("loss_text"))


def _read_turn(piece):
    fields = F.split(F.substring(piece, F.lit(len(START) + 1), F.length(piece)), r"\Q" + SEPARATOR + r"\E", 2)
    return F.struct(unescape(fields[0]).alias("role"), unescape(fields[1]).alias("text"))


def records_of(rows: DataFrame) -> DataFrame:
    """(conv_id, record) from rows of (conv_id, turn, role, text): one JSON record per conversation.

    Turns are ordered by turn, then role and text; null roles and texts count as empty. A user and
    an assistant turn make a prompt record, the same after a system turn an instruction record,
    all others a list of messages.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    t, roles = F.col("turns"), F.col("turns.role")

    def text(i):
        return t[i]["content"]

    return turns.select("conv_id", F.when(
        roles == F.array(F.lit("user"), F.lit("assistant")),
        F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))),
    ).when(
        roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")),
        F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))),
    ).otherwise(
        F.to_json(F.struct(F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")))
    ).alias("record"))


def digest(formatted: DataFrame) -> DataFrame:
    """The columns of the registered query, read back from the formatted strings and masks."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# A conversation whose texts hold control strings only, formatted beside those of the table.
PROBE = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """The operator over a table of turns: records, canonical turns, formatted strings with masks."""
    probe = rows.sparkSession.createDataFrame([*PROBE], "conv_id bigint, turn bigint, role string, text string")
    rows = rows.selectExpr("cast(conv_id as bigint) conv_id", "cast(turn as bigint) turn", "role", "text").unionByName(probe)
    return format_turns(canonical_turns(records_of(rows)))


def digest_sql():
    """DuckDB SQL for the registered query, from the rows alone."""
    marks = len(START) + len(SEPARATOR) + len(END)
    control = CONTROL.replace("'", "''")

    def escaped(column):
        return f"length(regexp_replace(replace({column}, '\\', '\\\\'), '{control}', '\\1\\3#\\2\\4', 'g'))"

    probe = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in PROBE)
    return f"""
        WITH r AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT * FROM (VALUES {probe}) AS p(conv_id, turn, role, text)
        ), g AS (
          SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
            coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
            sum({escaped('role')} + {escaped('text')} + {marks}) AS formatted_chars
          FROM r GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
          sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM g
    """
