"""Chat formatting by schema fingerprints.

A record is a JSON object of some layout: messages, prompt and completion,
instruction and input. ``fingerprint`` hashes its nested field paths, the hash
selects a declarative ``Mapping``, and the mapping's expression gives canonical
turns. ``records_of_rows`` is the other direction: it writes rows of turns as
records, each conversation in the layout its hash deals it. ``render`` writes turns into one text per conversation with a loss mask,
``read_back`` is its inverse. All of it is built-in functions.

Template: ``<|role|>``, a line feed, the text, ``<|end|>``, a line feed. Inside
texts ``%``, ``<`` and ``[`` become ``%25``, ``%3C`` and ``%5B`` (in roles also
the line feed and ``|``), so no control string of this or of other templates
can occur there, and decoding in the opposite order gives the text back.

Defined cases: null text is empty, null role is ``""``, rows without a
conversation id form one conversation, rows with the same turn number go by
role and text, a record that is no JSON or has an unknown fingerprint has null
turns and layout (it is kept, not dropped). Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TEXT_ESCAPES = (("%", "%25"), ("<", "%3C"), ("[", "%5B"))
ROLE_ESCAPES = (*TEXT_ESCAPES, ("|", "%7C"), ("\n", "%0A"))
TURNS = "array<struct<role:string,text:string>>"
LARGE = 1 << 24  # bytes of a record from which on parsing to a variant may fail: 20 million characters a text, 128 MiB
WHOLE = {"maxStringLen": str(2**31 - 1)}


@dataclass(frozen=True)
class Mapping:
    """How records with one of ``paths`` (as ``field_paths`` writes them) become turns.

    ``fields`` of a flat layout are (JSON path, role); null and absent fields
    give no turn. ``messages`` is (JSON path, role field, text field) of a
    layout that holds a list. ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    def turns(self, record: Column) -> Column:
        """Canonical turns of a variant."""
        return self._canonical(lambda path, kind: F.variant_get(record, path, kind))

    def _canonical(self, field: Callable[[str, str], Column]) -> Column:
        if self.messages:
            path, role, text = self.messages
            return F.transform(
                field(path, f"array<struct<`{role}`:string,`{text}`:string>>"),
                lambda m: F.struct(
                    self._renamed(F.coalesce(m[role], F.lit(""))).alias("role"),
                    F.coalesce(m[text], F.lit("")).alias("text"),
                ),
            )
        turns = [
            F.struct(F.lit(role).alias("role"), field(path, "string").alias("text")) for path, role in self.fields
        ]
        return F.filter(F.array(*turns), lambda t: t["text"].isNotNull())

    def written(self, role: Column, text: Column) -> Column:
        """One turn as a JSON record of this layout; null if the layout cannot say this role."""
        if self.messages:
            path, as_role, as_text = self.messages
            taken = F.lit(False)  # a role that reading would rename
            given = role
            for old, new in self.roles:
                taken = taken | (role == old)
                given = F.when(role == new, F.lit(old)).otherwise(given)
            turn = F.struct(given.alias(as_role), text.alias(as_text))
            return F.when(~taken, F.to_json(F.struct(F.array(turn).alias(_key(path)))))
        places, members = {}, []
        for path, as_role in self.fields:
            first = places.setdefault(as_role, path) == path
            members.append(F.when(F.lit(first) & (role == as_role), text).alias(_key(path)))
        record = F.to_json(F.struct(*members), {"ignoreNullFields": "false"})
        return F.when(role.isin(*places), record)

    def keys(self) -> list[list[str]]:
        """The sorted outer field names that records of this layout may have."""
        if self.messages:
            return [[_key(self.messages[0])]]
        return [sorted(p.removeprefix("OBJECT<").removesuffix(">").split(", ")) for p in self.paths]

    def turns_of_text(self, record: Column) -> Column:
        """As ``turns``, from JSON text, for records that are too large for a variant."""
        if self.messages:
            path, role, text = self.messages
            schema = f"`{_key(path)}` array<struct<`{role}`:string,`{text}`:string>>"
        else:
            schema = ", ".join(f"`{_key(path)}` string" for path, _ in self.fields)
        return self._canonical(lambda path, _: F.from_json(record, schema, WHOLE)[_key(path)])

    def _renamed(self, role: Column) -> Column:
        out = role
        for old, new in self.roles:
            out = F.when(role == old, F.lit(new)).otherwise(out)
        return out


def _key(path: str) -> str:
    return path.removeprefix("$.")


def _listed(outer: str, role: str, text: str) -> tuple[str, ...]:
    both = ", ".join(sorted((role, text)))
    return (f"OBJECT<{outer}: ARRAY<OBJECT<{both}>>>", f"OBJECT<{outer}: ARRAY<>>")


MAPPINGS = (
    Mapping("messages", _listed("messages", "role", "content"), messages=("$.messages", "role", "content")),
    Mapping(
        "conversations",
        _listed("conversations", "from", "value"),
        messages=("$.conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Mapping(
        "instruction",
        ("OBJECT<input, instruction, output>", "OBJECT<instruction, output>"),
        fields=(("$.instruction", "user"), ("$.input", "user"), ("$.output", "assistant")),
    ),
    Mapping(
        "prompt",
        ("OBJECT<completion, prompt>", "OBJECT<completion, prompt, system>"),
        fields=(("$.system", "system"), ("$.prompt", "user"), ("$.completion", "assistant")),
    ),
    Mapping("response", ("OBJECT<prompt, response>",), fields=(("$.prompt", "user"), ("$.response", "assistant"))),
    Mapping("question", ("OBJECT<answer, question>",), fields=(("$.question", "user"), ("$.answer", "assistant"))),
)


def field_paths(record: Column) -> Column:
    """The nested field names of a variant without the types of the leaves."""
    schema = F.schema_of_variant(record)
    named = F.regexp_replace(schema, r": (?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]+\))?", "")
    return F.regexp_replace(named, r"ARRAY<[A-Z]+(\([0-9, ]+\))?>", "ARRAY<>")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def canonical_turns(records: DataFrame, record: str = "record", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """Adds ``layout`` and ``turns`` (canonical) for a column of JSON texts.

    A record that is too large for a variant has no nested field paths; its outer field names choose the mapping.
    """
    spark = records.sparkSession
    shapes = [(path, m.name) for m in mappings for path in m.paths]
    hashed = spark.createDataFrame(shapes, "path string, name string").select(fingerprint(F.col("path")), "name")
    layouts: dict[str, list[int]] = {}
    for key, name in hashed.collect():  # as many rows as there are declared shapes
        layouts.setdefault(name, []).append(key)
    parsed = records.withColumn("_variant", F.try_parse_json(F.col(record)))
    parsed = parsed.withColumn("_print", fingerprint(field_paths(F.col("_variant"))))
    known = F.col("_variant").isNotNull()
    large = ~known & (F.octet_length(record) >= LARGE)
    outer = F.sort_array(F.json_object_keys(F.col(record)))
    layout = turns = F.lit(None)
    for m in reversed(mappings):
        chosen = known & F.col("_print").isin(layouts[m.name])
        whole = large & F.coalesce(outer.isin([F.array(*map(F.lit, keys)) for keys in m.keys()]), F.lit(False))
        layout = F.when(chosen | whole, F.lit(m.name)).otherwise(layout)
        turns = (
            F.when(chosen, m.turns(F.col("_variant")).cast(TURNS))
            .when(whole, m.turns_of_text(F.col(record)).cast(TURNS))
            .otherwise(turns)
        )
    return parsed.withColumns({"layout": layout, "turns": turns}).drop("_variant", "_print")


def records_of_rows(
    rows: DataFrame, key: str, order: str, role: str, text: str, mappings: Sequence[Mapping] = MAPPINGS
) -> DataFrame:
    """One JSON record per turn, (key, order, record), in the layout that the hash of the conversation deals it.

    A role that the dealt layout has no place for is written in the first layout
    of ``mappings``, which must take every role.
    """
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    dealt = F.pmod(F.xxhash64(F.col(key)), F.lit(len(mappings)))
    record = F.lit(None).cast("string")
    for k, m in enumerate(mappings):
        record = F.when(dealt == k, m.written(*said)).otherwise(record)
    return rows.select(F.col(key), F.col(order), F.coalesce(record, mappings[0].written(*said)).alias("record"))


def turns_of_records(
    records: DataFrame, key: str, order: str, record: str = "record", mappings: Sequence[Mapping] = MAPPINGS
) -> DataFrame:
    """(key, turns, n_unknown) per conversation from records with any number of turns, in the order given.

    Records of an unknown fingerprint give no turns; ``n_unknown`` tells how many a conversation has.
    """
    mapped = canonical_turns(records.select(key, order, record), record, mappings)
    given = F.coalesce(F.col("turns"), F.array().cast(TURNS))
    each = F.struct(F.col(order).alias("at"), given.alias("turns"))
    grouped = mapped.groupBy(F.col(key)).agg(
        F.sort_array(F.collect_list(each)).alias("_all"),
        F.sum(F.col("layout").isNull().cast("long")).alias("n_unknown"),
    )
    return grouped.select(key, F.flatten(F.transform("_all", lambda r: r["turns"])).alias("turns"), "n_unknown")


def _escaped(text: Column, escapes: Sequence[tuple[str, str]]) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _unescaped(text: Column, escapes: Sequence[tuple[str, str]]) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def render(df: DataFrame, turns: str = "turns", loss_role: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss_mask``: per turn the characters to skip and to learn."""
    head = lambda t: F.concat(F.lit(OPEN), _escaped(t["role"], ROLE_ESCAPES), F.lit(CLOSE))
    body = lambda t: _escaped(t["text"], TEXT_ESCAPES)
    pieces = F.transform(turns, lambda t: F.concat(head(t), body(t), F.lit(END)))
    mask = F.transform(
        turns,
        lambda t: F.struct(
            F.length(head(t)).alias("skip"),
            F.when(t["role"] == loss_role, F.length(body(t))).otherwise(F.lit(0)).alias("learn"),
        ),
    )
    return df.withColumns({"formatted": F.array_join(pieces, ""), "loss_mask": mask})


def read_back(df: DataFrame, formatted: str = "formatted", loss_mask: str = "loss_mask") -> DataFrame:
    """Adds ``read_turns`` and ``loss_texts`` (unescaped, one per turn, empty outside the mask), from the output alone."""
    pieces = F.split(F.col(formatted), r"<\|end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    df = df.withColumn("_pieces", pieces)
    turn = lambda p: F.struct(
        _unescaped(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), CLOSE, 1), ROLE_ESCAPES).alias("role"),
        _unescaped(F.substr(p, F.locate(CLOSE, p) + F.lit(len(CLOSE))), TEXT_ESCAPES).alias("text"),
    )
    learnt = F.zip_with("_pieces", loss_mask, lambda p, m: F.substr(p, m["skip"] + 1, m["learn"]))
    return df.withColumns(
        {
            "read_turns": F.transform("_pieces", turn),
            "loss_texts": F.transform(learnt, lambda t: _unescaped(t, TEXT_ESCAPES)),
        }
    ).drop("_pieces")
