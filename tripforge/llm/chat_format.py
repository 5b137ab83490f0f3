"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record in any registered layout is parsed as a variant. Its nested field paths
are hashed; the first layout all of whose own paths are among them gives the
declarative mapping to canonical turns, whatever other fields a record has. Paths of
texts that the mapping does not take are told beside the turns, so that no text is lost
without a word.
Turns are written with a template whose control strings cannot occur inside a
text, and can be read back.

Template of a turn: `<turn ROLE>`, a line feed, the text, `</turn>`, a line
feed. In texts, `<` followed by any number of backslashes and `turn ` or `/turn>`
gets one more backslash; reading back takes one off, so every text comes back
as it was. A role of other characters than letters, digits, `_` and `-` is
written as `x:` and its hexadecimal UTF-8.

Records may be as large as Spark rows. Spark's variants hold no string over 20,000,000 characters and no record over
128 MiB. Of a record over LONG bytes the variant is built from a copy whose string
values are blanked, and the texts are read from the record's own JSON.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role string, text string>>".replace(" string", ":string")
END = "</turn>\n"
#: Bytes of a record from which its texts are read outside the variant, and of a blanked copy from which a variant may not hold it.
LONG, MOST_BLANKED = 10_000_000, 40_000_000
_WHOLE = f"map('mode', 'FAILFAST', 'maxStringLen', '{2**31 - 1}')"
#: What a variant's schema is made of: types with their opening, closings, names.
_TOKENS = r"OBJECT<|ARRAY<|(?:VOID|VARIANT|STRING)(?!: )|>|`(?:[^`]|``)*`|[A-Za-z_0-9]+(?=: )"


@dataclass(frozen=True)
class Layout:
    """The field paths that a record of this layout has among its own, and how its turns are read.

    In paths, `a.b` is a field of a field and `[]` an array's element; `[none]`
    stands for an array without elements, `{}` for an object or a mix of types.
    Odd names are in backticks. A layout's paths must be texts or other scalars.

    `turns` is SQL over __v, the variant, __long, the JSON text of a long record,
    whose variant has blanked texts, else null, and __hashes of the record's paths.
    `claims` is SQL over the same for the paths of texts that the turns hold, and `when`
    a condition on the record's values beside its paths.
    """

    name: str
    paths: tuple[str, ...]
    turns: str
    claims: str
    when: str = "true"


def field_paths(record: Column) -> Column:
    """Nested field paths of a variant, in order of their names, and those of them that hold texts or a mix of types: struct(paths, texts); null for null.

    One fold over the tokens of the variant's schema: an opening type adds a
    level that later names are put under, a closing one takes it away.
    """
    schema = F.schema_of_variant(record)
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("above"), F.lit("").alias("at"), none.alias("paths"), none.alias("texts"))

    def step(state: Column, token: Column) -> Column:
        above, at, paths, texts = state["above"], state["at"], state["paths"], state["texts"]
        under = F.when(F.size(above) > 0, F.get(above, F.size(above) - 1)).otherwise("")
        element, branch = F.concat(at, F.lit("[]")), F.array(F.concat(at, F.lit("{}")))
        name = F.concat(under, F.when(under != "", ".").otherwise(""), token)
        made = lambda levels, here, more, own=texts: F.struct(levels.alias("above"), here.alias("at"), more.alias("paths"), own.alias("texts"))
        grown = lambda level, here, more: made(F.concat(above, F.array(level)), here, more)
        one_more = F.concat(texts, F.array(at))
        return (
            F.when(token == "OBJECT<", grown(at, at, F.when(at != "", F.concat(paths, branch)).otherwise(paths)))
            .when(token == "VARIANT", made(above, at, F.concat(paths, branch), one_more))
            .when(token == "STRING", made(above, at, paths, one_more))
            .when(token == "ARRAY<", grown(under, element, F.concat(paths, F.array(element))))
            .when(token == ">", made(F.slice(above, 1, F.greatest(F.size(above) - 1, F.lit(0))), at, paths))
            .when((token == "VOID") & at.endswith("[]"), made(above, at, F.concat(paths, F.array(F.regexp_replace(at, r"\[\]$", "[none]")))))
            .when(token == "VOID", state)
            .otherwise(made(above, name, F.concat(paths, F.array(name))))
        )

    tokens = F.regexp_extract_all(schema, F.lit(_TOKENS), F.lit(0))
    return F.when(schema.isNotNull(), F.aggregate(tokens, start, step, lambda x: F.struct(F.array_sort(x["paths"]).alias("paths"), F.array_sort(x["texts"]).alias("texts"))))


def _blanked(raw: Column) -> Column:
    """JSON text with every string value empty; keys and all else stay."""
    # pairs of backslashes from the left, then escaped quotes: after that every quote delimits a string
    plain = F.replace(F.replace(raw, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    return F.regexp_replace(plain, r'("[^"]*+"\s*+:)|(")[^"]*+(")', "$1$2$3")


def _variant(raw: Column) -> Column:
    """The record as a variant, its texts blanked where it is long; null where it is no JSON. One that a variant may not hold even so stops the job."""
    blanked = _blanked(raw)
    over = F.raise_error(F.concat(F.lit("chat record does not fit a variant: its keys and marks alone have bytes "), F.octet_length(blanked).cast("string"))).cast("variant")
    long = F.coalesce(F.try_parse_json(blanked), F.when(F.octet_length(blanked) > MOST_BLANKED, over))
    return F.when(F.octet_length(raw) > LONG, long).otherwise(F.try_parse_json(raw))


#: Fields that hold a text for the system, the first that has one counts.
SYSTEM = ("system", "system_prompt")
#: Names that roles go by, in lower case, and the canonical ones.
ROLES = {"human": "user", "gpt": "assistant", "ai": "assistant", "chatgpt": "assistant", "bard": "assistant", "bing": "assistant", "bot": "assistant", "model": "assistant"}
_NO_TURNS, _NO_PATHS = f"cast(array() AS {TURNS})", "cast(array() AS array<string>)"


def _there(path: str) -> str:
    # never null, so that what follows an AND is not read for records that are no JSON
    return f"coalesce(array_contains(__hashes, xxhash64('{path}')), false)"


def _has(path: str) -> str:
    """SQL: whether a record has a path that ends in a scalar or, if it ends in `{}`, a mix of types."""
    return _there(path) if path.endswith("{}") else f"({_there(path)} AND NOT {_there(path + '{}')} AND NOT {_there(path + '[]')})"


def _turn(role: str, text: str) -> str:
    return f"named_struct('role', coalesce({role}, ''), 'text', coalesce({text}, ''))"


def _field(path: str) -> str:
    """SQL: a field's text. Of a long record, whose variant is blank, it comes from the record's own text."""
    own = f"variant_get(__v, '$.{path}', 'string')"
    return f"CASE WHEN {own} = '' AND __long IS NOT NULL THEN from_json(__long, 'struct<`{path}`:string>', {_WHOLE}).`{path}` ELSE {own} END"


def _text(path: str) -> str:
    """SQL: a field's text where there is one, else null."""
    return f"CASE WHEN {_has(path)} THEN nullif({_field(path)}, '') END"


def _claimed(always: tuple[str, ...], *where: tuple[str, str]) -> str:
    """SQL: paths that are always taken, and others where a condition holds."""
    listed = [f"'{p}'" for p in always] + [f"CASE WHEN {condition} THEN '{p}' END" for p, condition in where]
    return f"cast(array_compact(array({', '.join(listed)})) AS array<string>)"


_SYSTEM = f"coalesce({', '.join(map(_text, SYSTEM))})"
_SYSTEM_TURN = f"CASE WHEN {_SYSTEM} IS NOT NULL THEN array({_turn("'system'", _SYSTEM)}) ELSE {_NO_TURNS} END"
#: A second system text is not taken.
_SYSTEM_CLAIMS = tuple((p, f"{_text(p)} IS NULL OR {' AND '.join([f'{_text(q)} IS NULL' for q in SYSTEM[:k]] or ['true'])}") for k, p in enumerate(SYSTEM))


def _rows(path: str, kind: str) -> str:
    """SQL: an array at a path (or the record itself, if that is one), of a long record from its own text, which has no blanks."""
    if not path:
        return f"coalesce(from_json(__long, '{kind}', {_WHOLE}), variant_get(__v, '$', '{kind}'), cast(array() AS {kind}))"
    return f"coalesce(from_json(__long, 'struct<`{path}`:{kind}>', {_WHOLE}).`{path}`, variant_get(__v, '$.{path}', '{kind}'), cast(array() AS {kind}))"


def _role(role: str, names: dict[str, str] | None) -> str:
    if not names:
        return f"x.`{role}`"
    pairs = ", ".join(f"'{n}'" for pair in names.items() for n in pair)
    return f"coalesce(try_element_at(map({pairs}), lower(x.`{role}`)), x.`{role}`)"


def _listed(name: str, path: str, role: str, text: str, names: dict[str, str] | None = ROLES) -> tuple[Layout, ...]:
    """An array of objects, a system text before it as a turn of its own; a text field by itself, or, as `field[].part`, the parts of one joined. An array without elements is no turns."""
    field, _, part = text.partition("[].")
    kind = f"array<struct<`{role}`:string,`{field}`:{f'array<struct<`{part}`:string>>' if part else 'string'}>>"
    own = f"array_join(transform(x.`{field}`, p -> p.`{part}`), '', '')" if part else f"x.`{field}`"
    turns = f"concat({_SYSTEM_TURN if path else _NO_TURNS}, transform({_rows(path, kind)}, x -> {_turn(_role(role, names), own)}))"
    claims = _claimed((f"{path}[].{role}", f"{path}[].{text}"), *(_SYSTEM_CLAIMS if path else ()))
    return Layout(name, (f"{path}[].{text}", f"{path}[].{role}"), turns, claims), *(() if part else (Layout(name, (f"{path}[none]",), turns, claims),))


def _mixed(name: str, path: str, role: str, field: str, part: str) -> Layout:
    """An array of objects whose text field is a text in some and an array of parts in others; in parts, only `part` and `type` are taken."""
    kind = f"array<struct<`{role}`:string,`{field}`:variant>>"
    rows = _rows(path, kind)
    text = lambda x: f"coalesce(CASE WHEN schema_of_variant({x}) = 'STRING' THEN variant_get({x}, '$', 'string') END, array_join(transform(try_variant_get({x}, '$', 'array<struct<`{part}`:string>>'), p -> p.`{part}`), '', ''))"
    turns = f"concat({_SYSTEM_TURN}, transform({rows}, x -> {_turn(_role(role, ROLES), text(f'x.`{field}`'))}))"
    names = f"flatten(transform({rows}, x -> regexp_extract_all(schema_of_variant(x.`{field}`), '(`(?:[^`]|``)*`|[A-Za-z_0-9]+): ', 1)))"
    clear = f"size(array_except({names}, array('{part}', 'type'))) = 0"
    sound = f"forall({rows}, x -> x.`{field}` IS NULL OR schema_of_variant(x.`{field}`) IN ('STRING', 'VOID', 'ARRAY<VOID>') OR schema_of_variant(x.`{field}`) LIKE 'ARRAY<OBJECT<%{part}: STRING%')"
    return Layout(name, (f"{path}[].{field}{{}}", f"{path}[].{role}"), turns, _claimed((f"{path}[].{role}",), (f"{path}[].{field}", clear), *_SYSTEM_CLAIMS), sound)


_HISTORY = _rows("history", "array<array<string>>")
#: Earlier pairs of question and answer.
_HAS_HISTORY = f"({_there('history[][]')} AND NOT {_there('history[][]{}')} AND NOT {_there('history[]{}')} AND forall({_HISTORY}, h -> size(h) = 2))"
_HISTORY_TURNS = f"CASE WHEN {_HAS_HISTORY} THEN flatten(transform({_HISTORY}, h -> array({_turn("'user'", 'h[0]')}, {_turn("'assistant'", 'h[1]')}))) ELSE {_NO_TURNS} END"


def _pair(question: str, answer: str, *more: str) -> Layout:
    """A question and an answer. Fields `more` and a context, where they hold a text, go behind the question after a blank line each, a system text before it as a turn of its own, then a history of pairs."""
    behind = (*more, "context")
    asked = f"concat_ws('\n\n', nullif({_field(question)}, ''), {', '.join(map(_text, behind))})"
    turns = f"concat({_SYSTEM_TURN}, {_HISTORY_TURNS}, array({_turn("'user'", asked)}, {_turn("'assistant'", _field(answer))}))"
    claims = _claimed((question, answer, "history[none]"), *((p, _has(p)) for p in behind), ("history[][]", _HAS_HISTORY), *_SYSTEM_CLAIMS)
    return Layout(f"{question}_{answer}", (question, answer), turns, claims)


#: In order: of layouts whose paths a record has, the first counts. The last three of lists take roles as they are or choose one of two answers.
LAYOUTS = (
    *_listed("message_parts", "messages", "role", "content[].text"),
    _mixed("message_mixed", "messages", "role", "content", "text"),
    *_listed("messages", "messages", "role", "content"),
    *_listed("conversations", "conversations", "from", "value"),
    *_listed("conversation_roles", "conversations", "role", "content"),
    *_listed("conversation", "conversation", "role", "content"),
    *_listed("dialogue", "dialogue", "role", "text"),
    *_listed("turns", "turns", "role", "text", None),
    *_listed("chosen", "chosen", "role", "content"),
    *_listed("bare_messages", "", "role", "content"),
    _pair("instruction", "output", "input"),
    _pair("instruction", "response", "input"),
    _pair("prompt", "response"),
    _pair("prompt", "completion"),
    _pair("question", "answer"),
    _pair("question", "response"),
    _pair("query", "response"),
    _pair("input", "output"),
    _pair("inputs", "targets"),
)


def canonical_turns(records: DataFrame, raw_col: str = "raw", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds layout (string), fingerprint (long), turns (array of role, text) and unmapped (array of paths) to records of JSON text.

    The fingerprint is the hash of the hashes of a record's field paths; records
    of one shape share it. A record that has the paths of no layout, or that is
    no JSON, gets a null layout and null turns; it is kept. `unmapped` lists the paths of
    texts and mixed values that are not in the turns, all of them where the layout is
    null; it is null for what is no JSON. Columns of these names are replaced. A long record of a known layout that cannot be read whole stops
    the job.
    """
    hashes = F.col("__hashes")
    out = records.withColumn("__v", _variant(F.col(raw_col))).withColumn("__paths", field_paths(F.col("__v")))
    out = out.withColumns({"__hashes": F.transform("__paths.paths", lambda p: F.xxhash64(p)), "__long": F.when(F.octet_length(raw_col) > LONG, F.col(raw_col))})
    choice = " ".join(f"WHEN {' AND '.join([*map(_has, layout.paths), layout.when])} THEN {i}" for i, layout in enumerate(layouts))
    out = out.withColumn("__layout", F.expr(f"CASE {choice} END"))
    # flat choices, of which one branch is evaluated
    name = " ".join(f"WHEN {i} THEN '{layout.name}'" for i, layout in enumerate(layouts))
    turns = " ".join(f"WHEN {i} THEN cast({layout.turns} AS {TURNS})" for i, layout in enumerate(layouts))
    claims = " ".join(f"WHEN {i} THEN {layout.claims}" for i, layout in enumerate(layouts))
    made = {"unmapped": F.expr(f"array_except(__paths.texts, CASE __layout {claims} ELSE {_NO_PATHS} END)"), "fingerprint": F.when(hashes.isNotNull(), F.xxhash64(hashes)), "layout": F.expr(f"CASE __layout {name} END"), "turns": F.expr(f"CASE __layout {turns} END")}
    return out.withColumns(made).drop("__v", "__paths", "__hashes", "__layout", "__long")


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(turn |/turn>)", r"<\\$1$2")


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(turn |/turn>)", r"<$1$2")


def _role_out(role: Column) -> Column:
    return F.when(role.rlike(r"^[A-Za-z0-9_-]*\z"), role).otherwise(F.concat(F.lit("x:"), F.hex(F.encode(role, "utf-8"))))


def _role_in(role: Column) -> Column:
    return F.when(role.startswith("x:"), F.decode(F.unhex(F.substring(role, 3, 2**31 - 1)), "utf-8")).otherwise(role)


def format_turns(turns: Column, learned: tuple[str, ...] = ("assistant",)) -> tuple[Column, Column]:
    """(formatted text, loss mask). The mask is runs of characters, in order, that cover the text: struct(chars, loss)."""
    head = lambda t: F.concat(F.lit("<turn "), _role_out(t.role), F.lit(">\n"))
    formatted = F.array_join(F.transform(turns, lambda t: F.concat(head(t), _escaped(t.text), F.lit(END))), "")
    run = lambda n, loss: F.struct(n.cast("int").alias("chars"), loss.alias("loss"))
    mask = F.flatten(F.transform(turns, lambda t: F.array(run(F.length(head(t)), F.lit(False)), run(F.length(_escaped(t.text)), t.role.isin(*learned)), run(F.lit(len(END)), F.lit(False)))))
    return formatted, mask


def _turn_texts(formatted: Column) -> Column:
    """The formatted turns, each without its END."""
    split = F.split(formatted, END, -1)
    return F.slice(split, 1, F.size(split) - 1)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    return F.transform(
        _turn_texts(formatted),
        lambda p: F.struct(
            _role_in(F.regexp_extract(p, r"(?s)^<turn ([^>]*)>\n", 1)).alias("role"),
            _unescaped(F.regexp_replace(p, r"(?s)\A<turn [^>]*>\n", "")).alias("text"),
        ),
    )


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under a loss mask of `format_turns`, unescaped run by run. Each turn's runs are counted within the turn, so work grows with the text alone."""
    every_third = lambda k: F.filter(mask, lambda m, i: i % 3 == k)
    runs = F.zip_with(every_third(0), every_third(1), lambda h, t: F.struct((h.chars + 1).alias("at"), t.chars.alias("chars"), t.loss.alias("loss")))
    return F.array_join(F.zip_with(_turn_texts(formatted), runs, lambda p, r: F.when(r.loss, _unescaped(F.substring(p, r["at"], r.chars))).otherwise("")), "")


def format_chats(records: DataFrame, id_col: str = "conv_id", raw_col: str = "raw", learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per record: the id, layout, fingerprint, unmapped, formatted (string), loss_mask (runs of struct(chars, loss)).

    Records of an unknown layout have null formatted and loss_mask; `unmapped` is that of `canonical_turns`. Missing
    roles and texts count as empty. No turns give an empty text.
    """
    formatted, mask = format_turns(F.col("turns"), learned)
    return canonical_turns(records.select(F.col(id_col), F.col(raw_col).alias("raw"))).select(id_col, "layout", "fingerprint", "unmapped", formatted.alias("formatted"), mask.alias("loss_mask"))


def gather_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, turns) from a row per turn, in order of turn, role, text; null roles and texts are empty, rows with a null id form one conversation."""
    one = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.groupBy(F.col(id_col).cast("long").alias("conv_id")).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))).alias("turns"))


def as_records(gathered: DataFrame) -> DataFrame:
    """(conv_id, raw): JSON text of each conversation. Pairs of user and assistant take the prompt layout, others of the three common roles alone the conversations or the messages layout in turn; conversations of other roles keep them in the turns layout."""
    turns = F.col("turns")
    pair = (F.size(turns) == 2) & (turns[0].role == "user") & (turns[1].role == "assistant")
    common = F.forall(turns, lambda t: t.role.isin("user", "assistant", "system"))
    plain = (F.pmod("conv_id", F.lit(2)) == 0) & common
    prompt = F.to_json(F.struct(turns[0].text.alias("prompt"), turns[1].text.alias("response")))
    other = F.to_json(F.struct(F.transform(turns, lambda t: F.struct(F.when(t.role == "user", "human").when(t.role == "assistant", "gpt").otherwise(t.role).alias("from"), t.text.alias("value"))).alias("conversations")))
    messages = F.to_json(F.struct(F.transform(turns, lambda t: F.struct(t.text.alias("content"), t.role.alias("role"))).alias("messages")))
    as_they_are = F.to_json(F.struct(turns))
    return gathered.select("conv_id", F.when(F.coalesce(pair, F.lit(False)), prompt).when(F.coalesce(plain, F.lit(False)), other).when(F.coalesce(common, F.lit(False)), messages).otherwise(as_they_are).alias("raw"))


def digests(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation holds, read back from its text and mask."""
    text, mask = F.col("formatted"), F.col("loss_mask")
    read = formatted.select("conv_id", read_turns(text).alias("turns"), read_loss(text, mask).alias("loss"), F.length(text).cast("long").alias("formatted_chars"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(flat, "utf-8"), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "utf-8"), 256).alias("loss_sha256"), "formatted_chars")
