"""Registered text-check and normalisation queries (T*, P2-P14) over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.functions import text as X
from kindred.operators.signature import md5_low64
from kindred.plans.oracle import signed
from kindred.plans.registry import register
from kindred.session import read_table

CJK = "一-鿿"


def _docs(spark, d):
    return read_table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


#: Character references put behind every page, by its id: named ones with and without ``;``,
#: longest prefixes, numbers in both bases, code points the standard replaces, and none at all.
REFERENCES = ("&eacute; caf&eacute &copy2; &notit; &notin;", "&#233; &#xE9; &#XE9 &#128512; &#x80; &#0; &#xD800;",
              "&CounterClockwiseContourIntegral; &nosuch; & &; &# &#x; &amp;lt; &ampamp;", "&#0000000000000233;&#99999999999;&#11;&NotEqualTilde;",
              "plain")


def _marked_pages(spark, d):
    tail = F.get(F.array(*[F.lit(f"<p>{x}</p>") for x in REFERENCES]), (F.col("page_id") % len(REFERENCES)).cast("int"))
    return read_table(spark, d, "pages").select(F.col("page_id").alias("id"), F.concat("html", tail).alias("text"))


def _pages(spark, d):
    return read_table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"))


def _convs(spark, d):
    return read_table(spark, d, "conversations").select("conv_id", "turn", "text")


# Documents turned into texts on which every row check can go either way.
_LATIN = r"[^a-zA-Z]"
_ROMAJI = r"[^a-zA-Z0-9 ]"
MIXED_SQL = f"""(SELECT doc_id AS id, CASE doc_id % 9
    WHEN 0 THEN text WHEN 1 THEN '漢字' || doc_id || text WHEN 2 THEN '漢字語' WHEN 3 THEN 'ひらがな ' || text
    WHEN 4 THEN '[note] <p>' || text || '</p> () ()' WHEN 5 THEN '' WHEN 6 THEN 'éö — ñ'
    WHEN 7 THEN regexp_replace(text, '{_ROMAJI}', '', 'g') ELSE regexp_replace(text, '{_LATIN}', '', 'g') END AS text
  FROM documents)"""


def _mixed(spark, d):
    k, t = F.col("id") % 9, F.col("text")
    v = (F.when(k == 0, t).when(k == 1, F.concat(F.lit("漢字"), F.col("id"), t)).when(k == 2, F.lit("漢字語"))
         .when(k == 3, F.concat(F.lit("ひらがな "), t)).when(k == 4, F.concat(F.lit("[note] <p>"), t, F.lit("</p> () ()")))
         .when(k == 5, F.lit("")).when(k == 6, F.lit("éö — ñ"))
         .when(k == 7, F.regexp_replace(t, _ROMAJI, "")).otherwise(F.regexp_replace(t, _LATIN, "")))
    return _docs(spark, d).select("id", v.alias("text"))


#: Row checks on the mixed texts; a test asserts that none of them is constant.
MIXED_CHECKS: list[str] = []


def _check(name: str, spark_fn, sql_expr: str, out: str):
    MIXED_CHECKS.append(name)

    @register(name, f"SELECT id, {sql_expr} AS {out} FROM {MIXED_SQL}")
    def q(spark, d):
        return _mixed(spark, d).select("id", spark_fn(F.col("text")).alias(out))
    return q


_check("T1", X.is_japanese, "(text >= '一' AND text <= '鿿') OR (text >= '぀' AND text <= 'ヿ')", "is_japanese")
_check("T2", X.is_vietnamese, "NOT ((text >= '一' AND text <= '鿿') OR (text >= '぀' AND text <= 'ヿ'))", "is_vietnamese")
_check("T3", X.is_han, f"NOT regexp_matches(text, '[^{CJK}]')", "is_han")
_check("T4", X.is_latin, "regexp_matches(text, '^[a-zA-Z]+$')", "is_latin")
_check("T5", X.contains_latin_or_numbers, "regexp_matches(text, '[a-zA-Z0-9]+')", "has_latin_or_number")
_check("T6", X.count_han, f"CAST(length(text) - length(regexp_replace(text, '[{CJK}]', '', 'g')) AS INTEGER)", "han_count")
_check("T7", X.count_paren_pairs, "CAST((length(text) - length(replace(text, '()', ''))) // 2 AS INTEGER)", "paren_pairs")
_check("T8", X.contains_html, "regexp_matches(text, '<.*?>')", "has_html")
_check("T11", X.count_p_close,
       "CAST(CASE WHEN regexp_matches(text, '<.*?>') THEN (length(text) - length(replace(text, '</p>', ''))) // 4 ELSE 0 END AS INTEGER)",
       "p_close")
_check("T12", lambda c: X.matches(c, r"\[[^\]]*\]"), "regexp_matches(text, '\\[[^\\]]*\\]')", "has_brackets")
_check("T13", X.contains_kana, "regexp_matches(text, '[ぁ-ゖゝ-ヿー]')", "has_kana")
_check("T14", X.contains_romaji, r"""regexp_matches(text, '^[a-zA-Z0-9\s' || $p$!"#$%&'()*+,./:;<>?@_`{|}~$p$ || '\[\]\^\-\\]+$')""", "is_romaji")


@register("T9", r"""WITH e AS (SELECT event_id AS id, CASE event_id % 8 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN ' ' || event_id || '.5e3 '
    WHEN 2 THEN event_id || 'x' WHEN 3 THEN '-inf' WHEN 4 THEN event_type WHEN 5 THEN '1_' || event_id WHEN 6 THEN '_' || event_id
    ELSE regexp_extract(props, ':(.*)}', 1) END AS text FROM events)
SELECT id, regexp_matches(lower(trim(text)), '^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?(e[+-]?[0-9]+)?|\.[0-9]+|inf|infinity|nan)$') AS is_number
FROM e""")
def q_t9(spark, d):
    i = F.col("event_id")
    text = (F.when(i % 8 == 0, i.cast("string")).when(i % 8 == 1, F.concat(F.lit(" "), i, F.lit(".5e3 ")))
            .when(i % 8 == 2, F.concat(i, F.lit("x"))).when(i % 8 == 3, F.lit("-inf")).when(i % 8 == 4, F.col("event_type"))
            .when(i % 8 == 5, F.concat(F.lit("1_"), i)).when(i % 8 == 6, F.concat(F.lit("_"), i))
            .otherwise(F.regexp_extract("props", ":(.*)}", 1)))
    return read_table(spark, d, "events").select(i.alias("id"), X.is_number(text).alias("is_number"))


@register("P3", """SELECT doc_id AS id, lower(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) AS value,
  CAST(length(lower(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'))) AS INTEGER) AS length FROM documents""")
def q_p3(spark, d):
    v = X.alnum_lower(F.col("text"))
    return _docs(spark, d).select("id", v.alias("value"), F.length(v).alias("length"))


@register("P4", """SELECT doc_id AS id, CAST(length(text) AS INTEGER) AS length FROM documents""")
def q_p4(spark, d):
    return _docs(spark, d).select("id", F.length("text").alias("length"))


@register("P5", f"""WITH h AS (SELECT doc_id AS id,
  ('0x' || substr(md5(lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g'))), 17, 16))::UBIGINT AS u FROM documents)
SELECT id, {signed('u')} AS hash FROM h""")
def q_p5(spark, d):
    return _docs(spark, d).select("id", md5_low64(X.alnum_lower(F.col("text"))).alias("hash"))


@register("P7", """SELECT doc_id AS id,
  trim(regexp_replace(lower(regexp_replace(text, '[-&;''"<>]', ' ', 'g')), '\\s+', ' ', 'g')) AS clean FROM documents""")
def q_p7(spark, d):
    return _docs(spark, d).select("id", X.clean_a(F.col("text")).alias("clean"))


@register("P9", """SELECT conv_id, turn,
  replace(replace(replace(upper(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '^,+|,+$', '', 'g'),
    '(?:。)+$', ''), '(?:\\.)+$', ''), '(?:\\?)+$', ''), '(?:？)+$', '')), 'ẞ', 'SS'), ',', ''), ' ', '') AS clean
FROM conversations""")
def q_p9(spark, d):
    return _convs(spark, d).select("conv_id", "turn", X.clean_b(F.col("text")).alias("clean"))


@register("P10", """SELECT conv_id, turn, replace(regexp_replace(text, '[^\\p{L}\\p{N}_\\s]', '', 'g'), ' ', '') AS cleaned
FROM conversations""")
def q_p10(spark, d):
    return _convs(spark, d).select("conv_id", "turn", X.remove_special(F.col("text")).alias("cleaned"))


@register("P11", """SELECT page_id AS id, regexp_replace(html, '<(\\w+)(\\s+[^>]+)?>', '<\\1>', 'g') AS html FROM pages""")
def q_p11(spark, d):
    return _pages(spark, d).select("id", X.strip_tag_attributes(F.col("text")).alias("html"))


@register("P12", """SELECT page_id AS id,
  regexp_replace(regexp_replace(html, '<div>(.*?)</div>', '\\1\n', 'g'), '<[^>]+>', '\n', 'g') AS lines FROM pages""")
def q_p12(spark, d):
    return _pages(spark, d).select("id", X.html_to_lines(F.col("text")).alias("lines"))


# The rule of P13, P14 and T10 in DuckDB's regular expressions.
_TOKENS = ("(?is)<script\\b[^>]*>(.*?)</script>|<style\\b[^>]*>(.*?)</style>|<!--(.*?)-->"
           "|<!doctype\\s+([^>]*)>|<[a-z/!?][^>]*>")


def _text_list(items) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


_NAMES = X.NAMED_REFERENCES
_BARE = sorted((k for k in _NAMES if not k.endswith(";")), key=lambda k: (-len(k), k))
_OLD = "".join(X.CP1252[n] for n in range(0x80, 0xA0))
# the table of names as one row, and the rule for one reference
_TABLE = f"""names AS (SELECT map({_text_list(_NAMES)}, {_text_list(_NAMES.values())}) AS m),
marked AS (SELECT page_id, html || '<p>' || {_text_list(REFERENCES)}[page_id % {len(REFERENCES)} + 1] || '</p>' AS html FROM pages)"""
_POINT = f"""CASE WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN chr(65533)
  WHEN n BETWEEN 128 AND 159 THEN substr('{_OLD}', n - 127, 1)
  WHEN n BETWEEN 1 AND 8 OR n IN (11, 127) OR n BETWEEN 14 AND 31 OR n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN ''
  ELSE chr(n) END"""


def _point(number: str) -> str:
    return _POINT.replace("n ", f"(least({number}, 2000000)::INTEGER) ").replace("chr(n)", f"chr(least({number}, 1114111)::INTEGER)")


def _decoded(x: str) -> str:
    """Pieces between ampersands; each but the first has at most one reference, at its start."""
    dec, hexa = "regexp_extract(p, '^#([0-9]+);?', 1)", "regexp_extract(p, '^#[xX]([0-9a-fA-F]+);?', 1)"
    name, bare = "regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*;)', 1)", f"regexp_extract(p, '^({'|'.join(_BARE)})', 1)"
    rest = "substr(p, length(regexp_extract(p, '^#(?:[xX][0-9a-fA-F]+|[0-9]+);?', 0)) + 1)"
    return f"""(string_split({x}, '&')[1] || coalesce(array_to_string(list_transform(string_split({x}, '&')[2:], lambda p:
  CASE WHEN {dec} <> '' THEN {_point(f"TRY_CAST({dec} AS HUGEINT)")} || {rest}
       WHEN {hexa} <> '' THEN {_point(f"TRY_CAST('0x' || right({hexa}, 8) AS HUGEINT)")} || {rest}
       WHEN names.m[{name}] IS NOT NULL THEN names.m[{name}] || substr(p, length({name}) + 1)
       WHEN {bare} <> '' THEN names.m[{bare}] || substr(p, length({bare}) + 1)
       ELSE '&' || p END), ''), ''))"""


_CUT = f"regexp_replace(html, '{_TOKENS}', '\\1\\2\\3\\4', 'g')"
_CUT_APART = f"regexp_replace(html, '{_TOKENS}', chr(1) || '\\1\\2\\3\\4' || chr(1), 'g')"


@register("P13", f"""WITH {_TABLE}, c AS (SELECT page_id, html, {_CUT} AS cut FROM marked)
SELECT page_id AS id, CASE WHEN regexp_matches(html, '<.*?>') THEN {_decoded("cut")} ELSE html END AS text FROM c, names""")
def q_p13(spark, d):
    return _marked_pages(spark, d).select("id", X.text_of_html(F.col("text")).alias("text"))


@register("P14", f"""WITH {_TABLE}, c AS (SELECT page_id, html, unnest(string_split({_CUT_APART}, chr(1))) AS node,
    generate_subscripts(string_split({_CUT_APART}, chr(1)), 1) AS i FROM marked),
t AS (SELECT page_id, html, i, regexp_replace({_decoded("node")}, '^\\s+|\\s+$', '', 'g') AS x FROM c, names)
SELECT page_id AS id, CASE WHEN regexp_matches(any_value(html), '<.*?>') THEN
  CASE WHEN starts_with(any_value(html), '()<') THEN '()' ELSE '' END
  || coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE regexp_matches(x, '[a-zA-Z0-9]')), '') ELSE any_value(html) END AS text
FROM t GROUP BY page_id""")
def q_p14(spark, d):
    return _marked_pages(spark, d).select("id", X.latin_text_of_html(F.col("text")).alias("text"))


@register("T10", """SELECT page_id AS id,
  NOT regexp_matches(html, '<.*?>') OR len(regexp_extract_all(regexp_replace(html,
    '(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<!--.*?-->', '', 'g'), '(?i)<p[\\s/>]'))
    = (length(html) - length(replace(html, '</p>', ''))) // 4 AS p_balanced,
  NOT regexp_matches(html, '<.*?>') OR len(regexp_extract_all(html, '(?i)<p(\\s[^>]*)?/?>'))
    = (length(html) - length(replace(html, '</p>', ''))) // 4 AS p_balanced_regex FROM pages""")
def q_t10(spark, d):
    return _pages(spark, d).select("id", X.p_tags_balanced(F.col("text")).alias("p_balanced"),
                                   X.p_tags_balanced_regex(F.col("text")).alias("p_balanced_regex"))


# Answer checks: the first capitalised word of a turn against the next turn; in every third conversation the
# next turn is made to answer it.
def _clean_b_sql(x: str) -> str:
    x = f"regexp_replace(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '^,+|,+$', '', 'g')"
    for end in ("(?:。)+$", "(?:\\.)+$", "(?:\\?)+$", "(?:？)+$"):
        x = f"regexp_replace({x}, '{end}', '')"
    return f"replace(replace(upper({x}), ',', ''), ' ', '')"


def _special_sql(x: str) -> str:
    return f"replace(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), ' ', '')"


_ANSWERS_SQL = r"""WITH n AS (SELECT conv_id, turn, text, regexp_extract(text, '[A-Z]\w+') AS word,
    lead(turn) OVER w AS nturn, lead(text) OVER w AS ntext FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
a AS (SELECT conv_id, turn, word, CASE WHEN conv_id % 3 = 0 THEN {made} ELSE ntext END AS next FROM n WHERE nturn = turn + 1)
SELECT conv_id, turn, CASE WHEN coalesce(next, '') = '' OR word = '' THEN coalesce(next, '') = '' AND word = ''
  ELSE coalesce({test}, FALSE) END AS ok FROM a"""
_LINE1 = "list_filter(list_transform(string_split(next, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda y: y <> '')[1]"


def _answers(spark, d, made):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = _convs(spark, d).withColumns({"nturn": F.lead("turn").over(w), "ntext": F.lead("text").over(w)})
    word = F.regexp_extract("text", r"[A-Z]\w+", 0)
    return c.filter(F.col("nturn") == F.col("turn") + 1).withColumn(
        "next_text", F.when(F.col("conv_id") % 3 == 0, made(word)).otherwise(F.col("ntext")))


@register("T15", _ANSWERS_SQL.format(made="' ' || word || '.' || chr(10) || ntext",
                                     test=f"{_clean_b_sql(_LINE1)} = {_clean_b_sql('word')}"))
def q_t15(spark, d):
    j = _answers(spark, d, lambda w: F.concat(F.lit(" "), w, F.lit(".\n"), F.col("ntext")))
    return j.select("conv_id", "turn", X.answer_check_index("text", "next_text", F.lit("1"), r"[A-Z]\w+").alias("ok"))


@register("T16", _ANSWERS_SQL.format(made="'(' || word || ')'",
                                     test=f"{_clean_b_sql(_special_sql('word'))} = {_clean_b_sql(_special_sql('next'))}"))
def q_t16(spark, d):
    j = _answers(spark, d, lambda w: F.concat(F.lit("("), w, F.lit(")")))
    return j.select("conv_id", "turn", X.answer_check_text("text", "next_text", r"[A-Z]\w+").alias("ok"))


# --- P2 / P6 on questions assembled from conversations ---------------------------

QUESTIONS_SQL = """WITH c AS (SELECT conv_id, turn, role, text,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nrole,
    lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ntext FROM conversations),
g AS (SELECT conv_id, coalesce(string_agg(text, '{sep}' ORDER BY turn) FILTER (WHERE role = 'system'), '') AS gtext,
             coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'system'), '') AS gcompact
      FROM conversations GROUP BY conv_id),
u AS (SELECT conv_id, turn, text AS q, CASE WHEN nrole = 'assistant' THEN ntext ELSE '' END AS a,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM c WHERE role = 'user'),
ua AS (SELECT conv_id, string_agg(q || a, '' ORDER BY turn) AS compact_items,
              string_agg('Question ' || i || ': ' || q || '{sep}' || 'Answer ' || i || ': ' || a, '{sep}' ORDER BY turn) AS disp
       FROM u GROUP BY conv_id)
SELECT g.conv_id AS id, {cols} FROM g LEFT JOIN ua USING (conv_id)"""


def _questions(spark, d):
    from kindred.plans.fixtures import fx_questions
    return fx_questions(spark, d)


@register("P2", QUESTIONS_SQL.format(sep="\n", cols="gcompact || coalesce(compact_items, '') AS compact"))
def q_p2(spark, d):
    q = _questions(spark, d)
    return q.select("id", X.compact_question(F.col("general"), F.col("content")).alias("compact"))


@register("P6", QUESTIONS_SQL.format(sep="\n", cols=(
    "'_____GENERAL____: \n' || gtext || ' \n_____GENERAL_AUDIO_TEXT____: \n' || '' || ' \n_____CONTENT____: \n' "
    "|| coalesce(disp, '') AS display")))
def q_p6(spark, d):
    q = _questions(spark, d)
    return q.select("id", X.display_question(F.col("general"), F.col("content"), "\n").alias("display"))
