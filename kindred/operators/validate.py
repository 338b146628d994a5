"""T17 schema validation and T18 list flattening on semi-structured JSON.

Records arrive as JSON text; ``try_parse_json`` turns them into ``VARIANT`` and
every check is a column expression over ``variant_get`` / ``schema_of_variant``.
The first failing check of a record (in model order, nested objects checked
depth first) is its error, exactly one message per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -------------------------
# The question model: field -> type name, nested dict, or [item type].
_LANG6 = {"vi": "str", "en": "str", "ko": "str", "fr": "str", "ja": "str", "ru": "str"}
GENERAL_MODEL = {"G_text": "list", "G_text_translate": dict(_LANG6), "G_text_audio": "str",
                 "G_text_audio_translate": dict(_LANG6), "G_audio": "list", "G_image": ["str"]}
CONTENT_ITEM_MODEL = {"Q_text": "str", "Q_audio": "str", "Q_image": "str", "A_text": ["str"], "A_audio": "list",
                      "A_image": "list", "A_correct": ["str"], "explain": dict(_LANG6), "A_more_correct": ["str"],
                      "advance_explain": {"vi": "str", "en": "str"}, "langExplainAdvance": ["str"]}
QUESTION_MODEL = {"id": "int", "kind": "str", "general": GENERAL_MODEL, "content": [CONTENT_ITEM_MODEL], "scores": ["float"]}
# --------------------------------------------------------------------------

# variant type names accepted for each Python type (bool is an int in Python)
_ACCEPT = {
    "str": ["STRING"],
    "int": ["TINYINT", "SMALLINT", "INT", "BIGINT", "BOOLEAN"],
    "float": ["DOUBLE", "FLOAT", "DECIMAL"],
    "bool": ["BOOLEAN"],
    "list": ["ARRAY"],
    "dict": ["OBJECT"],
}
_PY_NAME = [("STRING", "str"), ("BOOLEAN", "bool"), ("TINYINT", "int"), ("SMALLINT", "int"), ("INT", "int"),
            ("BIGINT", "int"), ("DOUBLE", "float"), ("FLOAT", "float"), ("DECIMAL", "float"),
            ("ARRAY", "list"), ("OBJECT", "dict"), ("VOID", "NoneType")]


def _kind(v: Column) -> Column:
    """Base type name of a variant value: 'ARRAY', 'OBJECT', 'DECIMAL', ..."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def _is(v: Column, pytype: str) -> Column:
    return _kind(v).isin(_ACCEPT[pytype])


def _py_type(v: Column) -> Column:
    k = _kind(v)
    expr = F.lit(None).cast("string")
    for vt, py in reversed(_PY_NAME):
        expr = F.when(k == vt, F.lit(py)).otherwise(expr)
    return F.concat(F.lit("<class '"), F.coalesce(expr, F.lit("object")), F.lit("'>"))


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f'$["{name}"]', "variant")


def _shown(expected) -> str:
    """A model as the reference's messages print it."""
    if isinstance(expected, dict):
        return "{" + ", ".join(f"'{k}': {_shown(v)}" for k, v in expected.items()) + "}"
    if isinstance(expected, list):
        return "[" + ", ".join(_shown(v) for v in expected) + "]"
    return f"<class '{expected}'>"


def _let(value: Column, fn) -> Column:
    """Evaluate ``value`` once for ``fn`` (one-element ``transform``)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _field_checks(f: Column, name: str, expected) -> Column:
    """First error of one field (its checks are contiguous in model order, so
    grouping them under one binding keeps the first-error order)."""
    out = [F.when(f.isNull(), F.lit(f"Missing field: {name}"))]
    if isinstance(expected, dict):
        out.append(F.when(~_is(f, "dict"), F.concat(
            F.lit(f"Field '{name}' expected a nested object, got "), _py_type(f))))
        out.append(_model_checks(f, expected))
    elif isinstance(expected, list):
        item_t = "dict" if isinstance(expected[0], dict) else expected[0]
        out.append(F.when(~_is(f, "list"), F.concat(F.lit(f"Field '{name}' expected a list, got "), _py_type(f))))
        items = F.when(_is(f, "list"), f.cast("array<variant>"))
        bad = F.filter(items, lambda x: ~_is(x, item_t))
        out.append(F.when(F.size(bad) > 0, F.concat(
            F.lit(f"Items in field '{name}' expected {_shown(expected[0])}, got "), _py_type(F.element_at(bad, 1)))))
    else:
        out.append(F.when(~_is(f, expected), F.concat(
            F.lit(f"Field '{name}' expected <class '{expected}'>, got "), _py_type(f))))
    return F.coalesce(*out)


def _model_checks(v: Column, model: dict) -> Column:
    return F.coalesce(*[_bind_field(v, name, expected) for name, expected in model.items()])


def _bind_field(v: Column, name: str, expected) -> Column:
    def body(f):
        return _field_checks(f, name, expected)
    return _let(_field(v, name), body)


def first_error(json_text: Column, model: dict = QUESTION_MODEL) -> Column:
    """First validation error of a JSON record (null when valid); text that
    is not a JSON object reports the top-level field as missing.  The record is
    parsed once and each field is looked up once for all of its checks."""
    def body(v):
        return _model_checks(F.when(_is(v, "dict"), v), model)
    return _let(F.try_parse_json(json_text), body)


def validation_report(df: DataFrame, json_col: str, key_col: str, model: dict = QUESTION_MODEL) -> DataFrame:
    """Per record ``(key, first_error)`` for invalid records only."""
    return df.select(key_col, first_error(F.col(json_col), model).alias("first_error")).filter(
        F.col("first_error").isNotNull())


def error_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("first_error").agg(F.count(F.lit(1)).alias("n"))


#: The parts of JSON text: a string, one structural character, or a run of anything else.
_JSON_PART = r'"(?:[^"\\]|\\.)*"|[\[\]{},]|[^"\[\]{},]+'


def flatten_json_list(json_text: Column) -> Column:
    """Every non-list leaf of a (ragged) JSON list, depth first, as JSON
    text, however deep the lists are nested; anything but a list has no leaf.

    Outside strings and objects, brackets are dropped and commas separate
    leaves, so one pass over the parts of the normalised text is enough."""
    v = F.try_parse_json(json_text)
    parts = F.regexp_extract_all(F.to_json(v), F.lit(_JSON_PART), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))

    def step(acc, part):
        outside = acc["depth"] == 0
        shown = (F.when(outside & part.isin("[", "]"), F.lit(""))
                 .when(outside & (part == ","), F.lit("\x02")).otherwise(part))
        inner = F.when(part == "{", 1).when(part == "}", -1).otherwise(0)
        return F.struct((acc["depth"] + inner).alias("depth"), F.concat(acc["out"], shown).alias("out"))

    leaves = F.split(F.aggregate(parts, start, step, lambda acc: acc["out"]), "\x02")
    return F.when(_is(v, "list"), F.filter(leaves, lambda x: F.trim(x) != "")).otherwise(F.array().cast("array<string>"))
