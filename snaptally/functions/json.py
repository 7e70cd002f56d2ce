"""Column expressions that decide whether a text line is one JSON object.

A line is a *good record* when the whole line (outer white space aside) is
exactly one JSON object. Spark's parsers stop after the first complete value
and ignore what follows, so the line is read inside two different wrappers:

* ``{"w":`` line ``}``    must parse and its ``w`` must be an object
                          (rejects an extra ``]`` or ``,v``);
* ``[`` line ``]``        must be an array of exactly one element
                          (rejects an extra ``}`` or ``,"k":v``).

Text that closes one wrapper early cannot close the other one, so requiring
both leaves no gap (tests cover every case, and a property test compares with
an independent validator). Strict mode uses
``try_parse_json`` (VARIANT: strict grammar, duplicate keys rejected);
lenient mode uses ``from_json`` with single quotes, ``NaN``, bare field
names and raw control characters allowed; duplicate keys of the record itself
are rejected there too.

``try_parse_json`` refuses strings of 20,000,000 characters, values of 128 MiB and
1,000 levels of nesting. A line that it refuses and that is large or deep enough for
one of these limits is *peeled* (:func:`peeled`): long strings and keys become
digests of their whole content, then the innermost objects and arrays are parsed, each by
itself, and replaced by a number, level by level, until nothing is left to replace. Every
object is so tested for syntax and for duplicate keys, as in a small line, and what
remains of the line goes through the two wrappers. No line is bad for its size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, NullType, StringType, StructField, StructType, VariantType

from snaptally.functions._cols import as_col

# The reserved field names of a record and the table used for
# records that do not name one.
TABLE_FIELD = "~table"
RECORD_SIZE_FIELD = "~recordSize"
UNKNOWN_TABLE = "unknown"

# Our own names: the checksum intrinsic, the error code of a bad line and the
# kinds of bad line.
CHECKSUM_FIELD = "~checksum"
ERROR_CODE = "MALFORMED_JSON"
EMPTY_LINE = "EMPTY_LINE"            # nothing but white space
NOT_AN_OBJECT = "NOT_AN_OBJECT"      # valid JSON, but null, an array or a scalar
TRAILING_CONTENT = "TRAILING_CONTENT"  # an object followed by more members or brackets
INVALID_JSON = "INVALID_JSON"        # anything else: syntax error, cut line, duplicate key, NaN

_LENIENT_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowUnquotedFieldNames": "true",
    "allowNonNumericNumbers": "true",
    "allowUnquotedControlChars": "true",
    "mode": "PERMISSIVE",
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "maxNestingDepth": str(2**31 - 1),
}

# the strict grammar with the parser's limits raised
_LARGE_OPTIONS = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "mode": "PERMISSIVE",
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "maxNestingDepth": str(2**31 - 1),
}

#: Bytes and nesting from which a refused line may have met a limit of the parser.
LARGE_BYTES = 16_000_000
DEEP_LEVELS = 900
LONG_STRING = 64  #: characters between quotes from which a string of such a line becomes a digest
PEELED = "-7777777"  #: stands for an object or array that was parsed by itself
# a JSON string literal, and a container that holds no other one
_STRING = r'"(?:[^"\\\x00-\x1F]++|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+"'
_INNERMOST = r'[\[{](?:[^\[\]{}"]++|' + _STRING + r")*+[\]}]"


def _digested(v: Column) -> Column:
    """The text with every long string literal as a literal of its content's digest, so
    that equal strings (however they're escaped) stay equal and different ones different."""
    def short(x):
        content = F.when(F.contains(x, F.lit("\\")), F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>", _LARGE_OPTIONS).getItem(0)).otherwise(x.substr(F.lit(2), F.length(x) - 2))
        return F.when(F.length(x) <= LONG_STRING, x).otherwise(F.concat(F.lit('"'), F.sha2(content, 256), F.lit('"')))

    between, literals = F.split(v, _STRING, -1), F.regexp_extract_all(v, F.lit(_STRING), F.lit(0))
    return F.array_join(F.zip_with(between, literals, lambda gap, x: F.concat(gap, F.coalesce(short(x), F.lit("")))), "")


def peeled(v: Column) -> Column:
    """What remains of a line when its containers, from the innermost on, are parsed by
    themselves and replaced by ``PEELED``; NULL if one of them is bad. Work is the
    length of what remains, once a level."""
    def is_good(x):  # a container of scalars; its own size may still be beyond VARIANT
        names = F.map_keys(F.from_json(x, "map<string,string>", _LARGE_OPTIONS))
        large = F.when(F.startswith(x, F.lit("{")), F.size(names) == F.size(F.array_distinct(names))).otherwise(F.from_json(x, "array<string>", _LARGE_OPTIONS).isNotNull())
        return F.try_parse_json(x).isNotNull() | ((F.octet_length(x) >= LARGE_BYTES) & F.coalesce(large, F.lit(False)))

    def state(text, found):
        good = F.forall(found, is_good)
        rest = F.when(good, F.regexp_replace(text, _INNERMOST, PEELED))
        return F.struct(rest.alias("text"), (good & (F.size(found) > 0)).alias("more"))

    def level(acc, _):
        # the list of containers is bound once, then tested and replaced
        step = F.transform(F.array(F.regexp_extract_all(acc["text"], F.lit(_INNERMOST), F.lit(0))), lambda found: state(acc["text"], found))
        return F.when(acc["more"], step.getItem(0)).otherwise(acc)

    levels = F.octet_length(v) - F.octet_length(F.translate(v, "[{", ""))
    start = F.struct(_digested(v).alias("text"), (levels > 0).alias("more"))
    return F.aggregate(F.sequence(F.lit(0), levels), start, level, lambda acc: acc["text"])


@dataclass(frozen=True)
class ParsedLine:
    """Expressions of one parse of a line, in steps.

    ``first`` holds the expensive parse results as consecutive projections,
    each adding named hidden columns (a later one may read an earlier one);
    ``record``, ``is_valid`` and ``table_raw`` read only those columns. Separate
    projections stop the optimizer from inlining (and so repeating) a parse in
    every expression that uses it.
    """

    first: list[dict[str, Column]]
    record: Column       # the object (VARIANT strict, MAP<STRING,STRING> lenient); NULL when bad
    is_valid: Column     # BOOLEAN, never NULL
    table_raw: Column    # JSON text of the ``~table`` value, NULL when absent or JSON null
    error_kind: Column   # why a bad line is bad (meaningful only where is_valid is false)


_OBJ = "__snaptally_obj"
_ARR = "__snaptally_arr"
_REST = "__snaptally_rest"


def parse_line(col, lenient: bool = False) -> ParsedLine:
    """Build the validity test, the record and the raw table field of a line.

    Strict: the array wrapper is checked by ``json_array_length`` (a token
    scan that builds nothing; exactly one element), the object wrapper by one
    ``try_parse_json``; an object is recognised by a cast to an empty struct,
    which inspects no field. A good line that VARIANT cannot hold has a NULL
    record.
    """
    v = as_col(col)

    def in_array(x):
        return F.concat(F.lit("["), x, F.lit("]"))

    def in_object(x):
        return F.concat(F.lit('{"w":'), x, F.lit("}"))

    obj = F.col(_OBJ)
    arr = F.col(_ARR)
    blank = v.rlike(r"^[ \t\r\n]*$")
    if not lenient:
        rest = F.col(_REST)
        levels = F.octet_length(v) - F.octet_length(F.translate(v, "[{", ""))
        refused = (F.octet_length(v) >= DEEP_LEVELS) & ((F.octet_length(v) >= LARGE_BYTES) | (levels >= DEEP_LEVELS))
        # The array form is scanned only for lines whose object form parsed (a bad line then
        # throws once inside the parser, not twice); only refused lines beyond a limit are peeled.
        first = [
            {_OBJ: F.try_parse_json(in_object(v))},
            {
                _ARR: F.when(obj.isNotNull(), F.json_array_length(in_array(v))),
                _REST: F.when(obj.isNull() & refused, peeled(v)),
            },
        ]
        is_obj = F.try_variant_get(obj, "$.w", "struct<>").isNotNull()
        # what is left of a large line is short; an object is a peeled container that begins with a brace
        rest_parsed = F.try_parse_json(in_object(rest))
        rest_is_obj = F.coalesce(F.try_variant_get(rest_parsed, "$.w", "string") == PEELED, F.lit(False)) & v.rlike(r"^[ \t\r\n]*\{")
        rest_valid = rest_is_obj & (F.json_array_length(in_array(rest)) == 1)
        is_valid = F.coalesce(F.when(rest.isNotNull(), rest_valid).otherwise((arr == 1) & is_obj), F.lit(False))
        record = F.try_variant_get(obj, "$.w", "variant")
        whole_table = F.from_json(v, f"`{TABLE_FIELD}` variant", _LARGE_OPTIONS).getField(TABLE_FIELD)
        table_raw = F.when(obj.isNotNull(), F.try_variant_get(obj, f'$.w["{TABLE_FIELD}"]', "string")).otherwise(F.try_variant_get(whole_table, "$", "string"))
        kind = (
            F.when(blank, F.lit(EMPTY_LINE))
            .when(obj.isNull() & (rest.isNull() | rest_parsed.isNull()), F.lit(INVALID_JSON))
            .when(F.when(rest.isNotNull(), ~rest_is_obj).otherwise(~is_obj), F.lit(NOT_AN_OBJECT))
            .otherwise(F.lit(TRAILING_CONTENT))
        )
        return ParsedLine(first, record, is_valid, table_raw, kind)

    # elements cast to an empty struct: an object is skipped over, not copied
    parsed_arr = F.from_json(in_array(v), "array<struct<>>", _LENIENT_OPTIONS)
    first = [
        {_OBJ: F.from_json(in_object(v), "w map<string,string>", _LENIENT_OPTIONS).getField("w")},
        {_ARR: F.when(obj.isNotNull(), parsed_arr)},
    ]
    arr_ok = (F.size(arr) == 1) & arr.getItem(0).isNotNull()
    one_of_each = F.size(F.array_distinct(F.map_keys(obj))) == F.size(obj)
    is_valid = F.coalesce(arr_ok & obj.isNotNull() & one_of_each, F.lit(False))
    # a lenient reader cannot tell a non-object from a syntax error
    kind = (
        F.when(blank, F.lit(EMPTY_LINE))
        .when(obj.isNull() | ~one_of_each, F.lit(INVALID_JSON))
        .otherwise(F.lit(TRAILING_CONTENT))
    )
    return ParsedLine(first, obj, is_valid, obj.getItem(TABLE_FIELD), kind)


def variant_schema_to_ddl(schema: str) -> str:
    """Turn a merged record schema (``schema_of_variant_agg``) into a Spark
    type: ``OBJECT<…>`` becomes ``STRUCT<…>``, an object without any field
    ``VARIANT`` (Parquet has no empty struct) and an always-null ``VOID`` field
    ``STRING``; back-quoted field names are left as they are. Fields whose
    types conflict across records are ``VARIANT`` already."""
    return _with_types(schema.replace("OBJECT<>", "VARIANT"), {"OBJECT": "STRUCT", "VOID": "STRING"})


def variant_schema_to_type(schema: str) -> tuple[StructType, bool]:
    """The type that Spark's JSON reader infers for the records of a merged schema, and
    whether some field's types conflict (it is a string then). Fractions are doubles, always-null
    values strings, and fields that are only ever empty objects are left out."""
    conflict = False

    def of(kind):
        nonlocal conflict
        if isinstance(kind, VariantType):
            conflict = True
            return StringType()
        if isinstance(kind, NullType):
            return StringType()
        if isinstance(kind, DecimalType):
            return kind if kind.scale == 0 else DoubleType()
        if isinstance(kind, ArrayType):
            element = of(kind.elementType)
            return ArrayType(element) if element is not None else None
        if isinstance(kind, StructType):
            fields = [StructField(f.name, t) for f in kind.fields if (t := of(f.dataType)) is not None]
            return StructType(fields) if fields else None
        return kind

    fields = _with_types(schema, {"OBJECT": "STRUCT"})
    return of(StructType.fromDDL(f"r {fields}").fields[0].dataType) or StructType([]), conflict


def _with_types(schema: str, words: dict[str, str]) -> str:
    """The schema text with type names replaced; field names stay."""
    out, i, n = [], 0, len(schema)
    while i < n:
        ch = schema[i]
        if ch == "`":  # quoted name: copy through its closing quote (`` is an escaped quote)
            j = i + 1
            while j < n:
                if schema[j] == "`" and (j + 1 >= n or schema[j + 1] != "`"):
                    break
                j += 2 if schema[j] == "`" else 1
            out.append(schema[i:j + 1])
            i = j + 1
            continue
        if ch.isalpha() or ch == "_":
            j = i
            while j < n and (schema[j].isalnum() or schema[j] == "_"):
                j += 1
            word = schema[i:j]
            is_type = j >= n or schema[j] != ":"  # a bare field name is followed by ':'
            out.append(words.get(word, word) if is_type else word)
            i = j
            continue
        out.append(ch)
        i += 1
    return "".join(out)


def table_key(table_raw: Column) -> Column:
    """Table name of a record: the ``~table`` value, ``unknown`` when missing,
    JSON null or the record is bad. A non-string value keeps its JSON text."""
    return F.coalesce(table_raw, F.lit(UNKNOWN_TABLE))
