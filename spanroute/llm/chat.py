"""Chat formatting by schema fingerprints; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

#: Elements whose running totals gather together.
STEP = 256
TURNS = "array<struct<role:string,text:string>>"

# The template's control strings. Each begins with < or [, holds none of
# these but at its start (and <<, </ pairs), and is escaped in texts by a backslash after
# its first character.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("<<ROLE>>", "<</ROLE>>", "<</TURN>>")
REST = r"(/?INST\]|/?s>|<SYS>>|</SYS>>|<ROLE>>|</ROLE>>|</TURN>>)"


def escape(text: Column) -> Column:
    """No control string is left: after its first character and any backslashes comes one more backslash."""
    return F.regexp_replace(text, r"([\[<])(\\*)" + REST, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])\\(\\*)" + REST, "$1$2$3")


# --- layouts ---------------------------------------------------------------------------

#: Names of roles in other layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}

#: Declarative mappings: a layout's field paths, with their types, and how its turns are
#: read. ``list`` names an array with a role and a text field, whose roles are canonical
#: unless ``roles`` maps them; ``fields`` names single fields with their roles, in order.
LAYOUTS = [
    {"paths": ["messages[].content:STRING", "messages[].role:STRING"], "list": ("messages", "role", "content")},
    {"paths": ["turns[].role:STRING", "turns[].text:STRING"], "list": ("turns", "role", "text")},
    {"paths": ["conversations[].from:STRING", "conversations[].value:STRING"], "list": ("conversations", "from", "value"), "roles": ROLES},
    {"paths": ["completion:STRING", "prompt:STRING"], "fields": [("user", ["prompt"]), ("assistant", ["completion"])]},
    {"paths": ["prompt:STRING", "response:STRING"], "fields": [("user", ["prompt"]), ("assistant", ["response"])]},
    {"paths": ["answer:STRING", "question:STRING"], "fields": [("user", ["question"]), ("assistant", ["answer"])]},
    {"paths": ["instruction:STRING", "output:STRING"], "fields": [("user", ["instruction"]), ("assistant", ["output"])]},
    {"paths": ["input:STRING", "instruction:STRING", "output:STRING"], "fields": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
    {"paths": ["output:STRING", "prompt:STRING", "system:STRING"], "fields": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["output"])]},
]


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def schema_paths(record: Column) -> Column:
    """The sorted nested field paths of a JSON record with their types, as one text.

    The variant functions give the schema of each single field and of each element of a list,
    whose fields are then put together; no variant holds the whole record, which may be larger
    than one can be. A layout is told by the schema text of its paths alone, whatever the
    order of a record's fields. Strings are cut to some 64 characters first, as a schema
    doesn't depend on more. A null among a list's texts counts as text.
    """
    short = F.regexp_replace(record, r'"((?:[^"\\]|\\u[0-9a-fA-F]{4}|\\[^u]){0,64}+)[^"\\]*+(?:\\.[^"\\]*+)*+"', r'"$1"')
    lists = {x["list"][0] for x in LAYOUTS if "list" in x}
    singles = {p.partition(":")[0] for x in LAYOUTS if "fields" in x for p in x["paths"]}
    kinds = [f"`{n}`: array<variant>" for n in sorted(lists)] + [f"`{n}`: variant" for n in sorted(singles)]

    def fields(schema: Column) -> Column:
        inner = F.replace(F.substring(schema, F.lit(8), F.length(schema) - 8), F.lit(": VOID"), F.lit(": STRING"))
        return F.when(F.startswith(schema, F.lit("OBJECT<")), F.split(inner, ", ")).otherwise(F.array(schema))

    def merged(elements: Column) -> Column:
        each = F.array_distinct(F.transform(elements, F.schema_of_variant))
        return F.concat(F.lit("ARRAY<OBJECT<"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform(each, fields)))), ", "), F.lit(">>"))

    def paths(both: Column) -> Column:
        read, known = both["read"], F.lit("?")
        at = [(n, F.when(F.size(read[n]) > 0, merged(read[n])).otherwise("ARRAY<VOID>")) for n in sorted(lists)] + [(n, F.schema_of_variant(read[n])) for n in sorted(singles)]

        def kind(key: Column) -> Column:
            out = known
            for name, text in at:
                out = F.when(key == name, F.coalesce(text, F.lit("VOID"))).otherwise(out)
            return F.concat(key, F.lit(": "), out)

        return F.concat(F.lit("OBJECT<"), F.array_join(F.transform(F.array_sort(both["keys"]), kind), ", "), F.lit(">"))

    def parsed(text: Column) -> Column:
        return F.struct(F.json_object_keys(text).alias("keys"), F.from_json(text, f"struct<{', '.join(kinds)}>").alias("read"))

    return _let(_let(short, parsed), paths)


def _schema_text(paths: list[str]) -> str:
    """What :func:`schema_paths` gives for a record of such paths."""
    nested: dict[str, list[str]] = {}
    plain = []
    for p in paths:
        name, _, kind = p.partition(":")
        if "[]." in name:
            outer, _, inner = name.partition("[].")
            nested.setdefault(outer, []).append(f"{inner}: {kind}")
        else:
            plain.append(f"{name}: {kind}")
    plain += [f"{o}: ARRAY<OBJECT<{', '.join(sorted(x))}>>" for o, x in nested.items()]
    return f"OBJECT<{', '.join(sorted(plain))}>"


def fingerprint(record: Column) -> Column:
    return F.sha2(schema_paths(record), 256)


def canonical_role(role: Column) -> Column:
    """The role that a layout's own name stands for; other names stay."""
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(role))), role, F.lit("user"))


#: All fields of all layouts, each as its layout has it; absent ones are null.
FIELDS = {name: f"array<struct<`{x['list'][1]}`:string,`{x['list'][2]}`:string>>" for x in LAYOUTS if "list" in x for name in x["list"][:1]}
FIELDS |= {p.partition(":")[0]: "string" for x in LAYOUTS if "fields" in x for p in x["paths"]}
READ = f"struct<{','.join(f'`{n}`:{kind}' for n, kind in FIELDS.items())}>"


def _turns(read: Column, layout: dict) -> Column:
    if "list" in layout:
        name, role, text = layout["list"]
        return F.transform(read[name], lambda t: F.struct((canonical_role(t[role]) if "roles" in layout else F.coalesce(t[role], F.lit("user"))).alias("role"), F.coalesce(t[text], F.lit("")).alias("text")))
    turns = []
    for role, names in layout["fields"]:
        parts = [F.coalesce(read[n], F.lit("")) for n in names]
        text = parts[0] if len(parts) == 1 else F.array_join(F.filter(F.array(*parts), lambda p: p != ""), "\n\n")
        turns.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
    return F.array(*turns).cast(TURNS)


def to_turns(records: DataFrame, id_col: str = "id", record_col: str = "record") -> DataFrame:
    """id, fingerprint, turns (array of role and text) of JSON records of various layouts.

    The hash of a record's nested field paths selects the mapping from LAYOUTS. Turns are
    null where no layout has that fingerprint, or the record is null or no JSON. Null texts
    count as empty, null roles as user. Texts may be as long as a row, and turns as many as fit in one. Other columns are
    left out.
    """
    rows = pick(records, id_col, record_col).toDF("id", "record").withColumn("fingerprint", fingerprint(F.col("record")))

    def mapped(read: Column) -> Column:
        turns = F.lit(None).cast(TURNS)
        for layout in reversed(LAYOUTS):
            own = F.sha2(F.lit(_schema_text(layout["paths"])), 256)
            turns = F.when(F.col("fingerprint") == own, _turns(read, layout)).otherwise(turns)
        return turns

    turns = _let(F.from_json("record", READ, {"maxStringLen": str((1 << 31) - 1)}), mapped)
    return rows.select(F.col("id").alias(id_col), "fingerprint", turns.alias("turns"))


def records_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", mixed: bool = False) -> DataFrame:
    """A JSON record per conversation from a row per turn.

    Records are ``{"messages": [...]}``; with ``mixed`` they are of various layouts, as the
    files of several sources are: a prompt and its answer as two or three fields, other
    conversations as one of three lists, by the id's digest. A layout whose names of roles
    are mapped is only taken where all roles are those that come back.

    Turns come by number; rows that repeat a number are each kept, by role and text; a null
    number comes first. A null id is a conversation like others. A conversation is one
    record, which must fit in memory, as its formatted text must.
    """
    rows = pick(conversations, id_col, turn_col, role_col, text_col).toDF("id", "turn", "role", "text")
    one = rows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("rows"))

    def as_list(name: str, role: str, text: str, roles: Callable[[Column], Column] = lambda r: r) -> Column:
        return F.to_json(F.struct(F.transform("rows", lambda t: F.struct(roles(t["role"]).alias(role), t["text"].alias(text))).alias(name)))

    def as_fields(*names: str) -> Column:
        return F.to_json(F.struct(*[F.element_at("rows", i + 1)["text"].alias(n) for i, n in enumerate(names)]))

    record = as_list("messages", "role", "content")
    if mixed:
        roles, deal = F.transform("rows", lambda t: t["role"]), F.pmod(F.xxhash64("id"), F.lit(3))
        plain = F.forall(roles, lambda r: r.isin(*MARKS))
        other = F.create_map(*[F.lit(x) for pair in (("user", "human"), ("assistant", "gpt"), ("system", "system")) for x in pair])
        record = (
            F.when(roles == F.array(F.lit("user"), F.lit("assistant")), F.when(deal == 0, as_fields("prompt", "completion")).when(deal == 1, as_fields("question", "answer")).otherwise(as_fields("instruction", "output")))
            .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), as_fields("system", "prompt", "output"))
            .when(plain & (deal == 0), as_list("conversations", "from", "value", lambda r: F.element_at(other, r))).when(deal == 1, as_list("turns", "role", "text")).otherwise(record)
        )
    return one.select("id", record.alias("record"))


# --- template --------------------------------------------------------------------------


def _formatted(turn: Column) -> Column:
    text = escape(turn["text"])
    out = F.concat(F.lit(OTHER[0]), escape(turn["role"]), F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    for role, (head, tail) in MARKS.items():
        out = F.when(turn["role"] == role, F.concat(F.lit(head), text, F.lit(tail))).otherwise(out)
    return out


def _running(sizes: Column) -> Column:
    """The total before each element. Totals gather in blocks of STEP elements and then over
    blocks, as each step copies what it has gathered."""

    def before(values: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(values, start, lambda done, n: F.struct((done["total"] + n).alias("total"), F.concat(done["before"], F.array(done["total"])).alias("before")))

    def joined(blocks: Column) -> Column:
        own = before(F.transform(blocks, lambda b: b["total"]))["before"]
        return F.flatten(F.zip_with(blocks, own, lambda b, at: F.transform(b["before"], lambda x: x + at)))

    starts = F.when(F.size(sizes) > 0, F.sequence(F.lit(1), F.size(sizes), F.lit(STEP))).otherwise(F.array().cast("array<int>"))
    return _let(F.transform(starts, lambda s: before(F.slice(sizes, s, STEP))), joined)


def format_turns(rows: DataFrame, id_col: str = "id") -> DataFrame:
    """id, formatted, loss_spans, loss_bytes: the text of all turns and where the loss applies.

    Spans (start, length, in code points from 0) cover the escaped text of every assistant
    turn without its marks; loss_bytes gives the same spans in bytes of the UTF-8 text, by
    which a part is found without counting through all before it. Null turns give a null
    text and null spans.
    """
    head, tail = (len(m) for m in MARKS["assistant"])

    def spans(parts: Column, size: str) -> Column:
        at = _running(F.transform(parts, lambda p: p[size]))
        both = F.zip_with(parts, at, lambda p, a: F.struct(p["loss"].alias("loss"), (a + head).alias("start"), (p[size] - head - tail).alias("length")))
        return F.transform(F.filter(both, lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))

    def part(turn: Column) -> Column:
        return _let(_formatted(turn), lambda text: F.struct(text.alias("text"), (turn["role"] == "assistant").alias("loss"), F.length(text).cast("long").alias("n"), F.octet_length(text).cast("long").alias("bytes")))

    def whole(parts: Column) -> Column:
        return F.struct(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("formatted"), spans(parts, "n").alias("loss_spans"), spans(parts, "bytes").alias("loss_bytes"))

    done = rows.select(F.col(id_col), F.when(F.col("turns").isNotNull(), _let(F.transform("turns", part), whole)).alias("done"))
    return done.select(id_col, "done.*")


def read_back(formatted: Column) -> Column:
    """The turns, roles and unescaped texts, that a formatted text holds."""
    pairs = [*MARKS.values(), (OTHER[0], OTHER[2])]
    quoted = "|".join(rf"\Q{head}\E.*?\Q{tail}\E" for head, tail in pairs)
    segments = F.regexp_extract_all(formatted, F.lit(f"(?s){quoted}"), F.lit(0))

    def turn(s: Column) -> Column:
        inner = F.substring(s, F.lit(len(OTHER[0]) + 1), F.length(s) - len(OTHER[0]) - len(OTHER[2]))
        role = unescape(F.substring_index(inner, OTHER[1], 1))
        text = F.substring(inner, F.length(F.substring_index(inner, OTHER[1], 1)) + len(OTHER[1]) + 1, F.length(inner))
        for name, (head, tail) in MARKS.items():
            is_ = F.startswith(s, F.lit(head))
            role = F.when(is_, F.lit(name)).otherwise(role)
            text = F.when(is_, F.substring(s, F.lit(len(head) + 1), F.length(s) - len(head) - len(tail))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(segments, turn)


def loss_text(formatted: Column, loss_bytes: Column) -> Column:
    """All text under the spans (start, length in bytes), unescaped, nothing between."""
    texts = _let(formatted.cast("binary"), lambda raw: F.transform(loss_bytes, lambda s: unescape(F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))))
    return F.array_join(texts, "")


def format_report(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """A row per conversation, read back from its formatted text: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The rows become records of various layouts first. See :func:`records_of` for odd rows;
    an empty table gives no rows. No count is ever null: a record without turns is an error.
    """
    turns = to_turns(records_of(conversations, id_col, mixed=True))
    missing = F.raise_error(F.concat(F.lit("no layout has the fields of conversation "), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    done = format_turns(turns.select("id", F.when(F.col("turns").isNull(), missing.cast(TURNS)).otherwise(F.col("turns")).alias("turns")))
    back = done.select("id", "formatted", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_bytes")).alias("loss"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
    return back.select(
        F.col("id").alias(id_col), F.size("turns").cast("long").alias("n_turns"), digest.alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
