"""Exam assembly (E1-E12, W2, W3) as column expressions over nested exams.

An exam row: ``id, title, title_lang map<string,string>, level, parts
array<struct<name, time, ...>>`` plus optional ``active, type, score, time,
sequence, groups``.  Skill exams are produced with ``posexplode(parts)``;
titles are rewritten with regex/replace expressions per language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.text import py_strip
from kindred.operators.fill import sequential_ids

# --- fixed values that must equal the reference's -------------------------
SKILLS = ["Listening", "Reading", "Writing"]
SKILL_SUFFIX = {
    "Reading": {"vi": "Đọc", "en": "Reading", "ko": "읽기", "ja": "読解", "fr": "Lecture", "ru": "Чтение"},
    "Listening": {"vi": "Nghe", "en": "Listening", "ko": "듣기", "ja": "聞き取り", "fr": "Écoute",
                  "ru": "Аудирование"},
    "Writing": {"vi": "Viết", "en": "Writing", "ko": "쓰기", "ja": "書き取り", "fr": "Écriture", "ru": "Письмо"},
}
LANGS = ["vi", "en", "ko", "ja", "fr", "ru"]
# title templates per language; {n} is the test number
TITLE_TEMPLATES = {"vi": "Đề thi {n}", "en": "Test {n}", "ko": "{n} 번 시험지", "ja": "テスト {n}",
                   "fr": "Test {n}", "ru": "Тест {n}"}
# decrement patterns, first match wins (the reference lists "Test" twice)
DECREMENT_PREFIXES = ["Test ", "Đề thi ", None, "テスト ", "Тест "]
FILL_LANGS = ["ko", "ja", "fr", "ru"]
TRANSLATED_PREFIX = "[Translated from {lang}] "
REGULAR_FIRST_ID = 2700
AI_SKILL_FIRST_ID = 3004
# --------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a one-element ``transform``):
    Catalyst does not share subexpressions inside CASE branches or lambdas, so
    a regex result used three times would otherwise run three times."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def title_number(title) -> Column:
    """Trailing digits of the stripped title, else leading ``n 번``; null otherwise."""
    def body(t):
        tail = F.regexp_extract(t, r"(?U)(\d+)$", 1)
        head = F.regexp_extract(t, r"(?U)^(\d+)\s+번", 1)
        return F.coalesce(F.nullif(tail, F.lit("")).try_cast("long"), F.nullif(head, F.lit("")).try_cast("long"))
    return _let(py_strip(_c(title)), body)


def skill_suffix(skill, lang) -> Column:
    """Skill name in a language, else the name itself."""
    entries = []
    for s, per in SKILL_SUFFIX.items():
        for lg, txt in per.items():
            entries += [F.lit(f"{s}|{lg}"), F.lit(txt)]
    m = F.create_map(*entries)
    return F.coalesce(F.element_at(m, F.concat(_c(skill), F.lit("|"), _c(lang))), _c(skill))


def increment_for(level) -> Column:
    return F.when(_c(level) <= 2, F.lit(40)).otherwise(F.lit(15))


def _replace_num(text: Column, old: Column, new: Column) -> Column:
    return F.replace(text, old.cast("string"), new.cast("string"))


def renumber_title(title, inc) -> Column:
    """``Test {n + inc}`` when the title has a number, else unchanged."""
    n = title_number(title)
    return F.when(n.isNotNull(), F.concat(F.lit("Test "), (n + inc).cast("string"))).otherwise(_c(title))


def renumber_lang_title(lang: Column, text: Column, inc: Column) -> Column:
    """Korean ``n 번`` titles become ``{n+inc} 번 시험지``; other languages
    replace every occurrence of the number text."""
    ko_n = F.nullif(F.regexp_extract(text, r"(?U)^(\d+)\s+번", 1), F.lit("")).try_cast("long")
    n = title_number(text)
    return (F.when(lang == "ko", F.when(ko_n.isNotNull(), F.concat((ko_n + inc).cast("string"), F.lit(" 번 시험지")))
                   .otherwise(text))
            .when(n.isNotNull(), _replace_num(text, n, n + inc)).otherwise(text))


def renumber_regular(exams: DataFrame) -> DataFrame:
    """E3+E4: regular exams get +40 (level <= 2) or +15, ``active=0, type=4``."""
    inc = increment_for("level")
    return exams.withColumns({
        "title": renumber_title("title", inc),
        "title_lang": F.transform_values("title_lang", lambda k, v: renumber_lang_title(k, v, inc)),
        "active": F.lit(0), "type": F.lit(4)})


def _ko_number(v: Column) -> Column:
    return F.nullif(F.regexp_extract(v, r"(?U)^(\d+)\s+번", 1), F.lit("")).try_cast("long")


def _parsed_langs(title_lang) -> Column:
    """Per language ``struct(text, n, ko)`` for titles that carry a number, parsed once
    per exam (before the parts are exploded)."""
    parsed = F.transform_values(_c(title_lang), lambda k, v: F.struct(
        v.alias("text"), title_number(v).alias("n"), _ko_number(v).alias("ko")))
    return F.map_filter(parsed, lambda k, x: x["n"].isNotNull())


def _no_titles() -> Column:
    return F.create_map().cast("map<string,string>")


def split_skills(exams: DataFrame, inc: Column | None = None) -> DataFrame:
    """E5+E6: one exam per Listening/Reading/Writing part of an exam whose title
    has a number; ``score 100, type 5, active 0, sequence 0, groups []``.
    Titles are rewritten once per exam, before ``posexplode``, with no shuffle."""
    inc = increment_for("level") if inc is None else inc
    pre = exams.select(F.col("id").alias("exam_id"), "level", "parts", inc.alias("_inc"),
                       title_number("title").alias("_tn"), _parsed_langs("title_lang").alias("_tl"))
    new = lambda x: (x["n"] + F.col("_inc")).cast("string")
    base = F.transform_values("_tl", lambda k, x: F.when((k == "ko") & x["ko"].isNotNull(), F.concat(new(x), F.lit(" 번 시험지")))
                              .otherwise(F.replace(x["text"], x["n"].cast("string"), new(x))))
    pre = pre.filter(F.col("_tn").isNotNull()).select(
        "exam_id", "level", "_inc", "_tn", F.coalesce(base, _no_titles()).alias("_tl"), "parts")
    p = pre.select("exam_id", "level", "_inc", "_tn", "_tl", F.posexplode("parts").alias("part_pos", "part"))
    p = p.filter(F.col("part.name").isin(SKILLS))
    skill = F.col("part.name")
    return p.select(
        "exam_id", "part_pos", "level",
        F.concat(F.lit("Test "), (F.col("_tn") + F.col("_inc")).cast("string"), F.lit(" - "), skill).alias("title"),
        F.transform_values("_tl", lambda k, v: F.concat(v, F.lit(" - "), skill_suffix(skill, k))).alias("title_lang"),
        F.array("part").alias("parts"), F.col("part.time").alias("time"),
        F.lit(100).alias("score"), F.lit(0).alias("active"), F.lit(5).alias("type"), F.lit(0).alias("sequence"))


def assign_regular_ids(regular: DataFrame, order=("level", "test", "pos")) -> DataFrame:
    """W2 (regular part): ids from 2700 in (level, test, item) order."""
    return sequential_ids(regular, list(order), REGULAR_FIRST_ID, out="new_id")


def assign_skill_ids(skills: DataFrame, first_id: Column | int, order=("level", "test", "pos", "part_pos")) -> DataFrame:
    """W2 (skill part) / W3: ids continue from ``first_id`` in the given order."""
    out = sequential_ids(skills, list(order), 0, out="_k")
    base = first_id if isinstance(first_id, Column) else F.lit(first_id)
    return out.withColumn("new_id", (base + F.col("_k")).cast("long")).drop("_k")


# --- AI exams (E7-E12) -------------------------------------------------------

def fill_translations(m) -> Column:
    """ko/ja/fr/ru missing or empty -> en text as is, else vi text with the
    ``[Translated from vi]`` prefix; unchanged when neither template exists."""
    m = _c(m)
    en, vi = F.element_at(m, F.lit("en")), F.element_at(m, F.lit("vi"))
    has_en = en.isNotNull() & (en != "")
    has_vi = vi.isNotNull() & (vi != "")
    template = F.when(has_en, en).when(has_vi, F.concat(F.lit(TRANSLATED_PREFIX.format(lang="vi")), vi))
    defaults = F.create_map(*sum([[F.lit(lg), template] for lg in FILL_LANGS], []))
    keep = F.map_filter(m, lambda k, v: ~(k.isin(FILL_LANGS) & (v.isNull() | (v == "")) & template.isNotNull()))
    add = F.map_filter(defaults, lambda k, v: v.isNotNull() & ~F.map_contains_key(keep, k))
    return F.when(m.isNull(), m).otherwise(F.map_concat(keep, add))


def fill_exam_translations(parts) -> Column:
    """E7 on ``parts[].content[].Questions[].general.{G_text_translate,
    G_text_audio_translate}`` and ``...Questions[].content[].explain``."""
    def question(q):
        g = q["general"]
        g2 = (g.withField("G_text_translate", fill_translations(g["G_text_translate"]))
               .withField("G_text_audio_translate", fill_translations(g["G_text_audio_translate"])))
        items = F.transform(q["content"], lambda it: it.withField("explain", fill_translations(it["explain"])))
        return q.withField("general", g2).withField("content", items)

    return F.transform(_c(parts), lambda p: p.withField("content", F.transform(
        p["content"], lambda grp: grp.withField("Questions", F.transform(grp["Questions"], question)))))


def _decrement_step(t: Column, otherwise: Column, lit_fmt: tuple[str, str], by: int):
    def step(n):
        old_s = F.concat(F.lit(lit_fmt[0]), n.cast("string"), F.lit(lit_fmt[1]))
        new_s = F.concat(F.lit(lit_fmt[0]), F.greatest(n - by, F.lit(1)).cast("string"), F.lit(lit_fmt[1]))
        return F.when(n.isNotNull(), F.replace(t, old_s, new_s)).otherwise(otherwise)
    return step


def decrement_title(title, by: int = 60) -> Column:
    """First matching pattern (Test, Đề thi, leading n 번, テスト, Тест) has its
    number lowered by ``by`` (at least 1); every occurrence of that text changes."""
    def body(t):
        out = t
        for prefix in reversed(DECREMENT_PREFIXES):
            if prefix is None:
                pat, lit_fmt = r"^(\d+)\s+번", ("", " 번")
            else:
                pat, lit_fmt = "(?U)" + prefix + r"(\d+)", (prefix, "")

            out = _let(F.nullif(F.regexp_extract(t, pat, 1), F.lit("")).try_cast("long"),
                       _decrement_step(t, out, lit_fmt, by))
        return F.when(t.isNull(), t).otherwise(out)
    return _let(_c(title), body)


def exam_defaults(exams: DataFrame, file_level: Column | int = 0) -> DataFrame:
    """Defaults for AI exams and the six title templates for missing languages."""
    lvl = file_level if isinstance(file_level, Column) else F.lit(file_level)
    title_ok = F.col("title").isNotNull() & F.col("title").startswith("Test ")
    title = F.when(title_ok, F.col("title")).otherwise(
        F.concat(F.lit("Test "), F.coalesce(F.col("id"), F.lit(0)).cast("string")))
    # the number is parsed once, in a projection of its own: six templates use it
    numbered = exams.withColumn("title", title).withColumn("_tn", title_number("title"))
    num = F.when(F.col("_tn").isNull() | (F.col("_tn") == 0), F.coalesce(F.col("id"), F.lit(0))).otherwise(F.col("_tn"))
    tl = F.coalesce(F.col("title_lang"), _no_titles())
    tmpl = F.create_map(*sum([[F.lit(lg), F.concat(*[F.lit(x) if x != "{n}" else F.col("_num").cast("string")
                                                      for x in _split_template(TITLE_TEMPLATES[lg])])]
                              for lg in LANGS], []))
    full_tl = F.map_concat(tl, F.map_filter(tmpl, lambda k, v: ~F.map_contains_key(tl, k)))
    parts = F.transform(F.col("parts"), lambda p, i: p.withField("time", F.coalesce(p["time"], F.lit(15)))
                        .withField("name", F.coalesce(p["name"], F.concat(F.lit("Part "), (i + 1).cast("string")))))
    return numbered.withColumn("_num", num).withColumns({
        "active": F.coalesce(F.col("active"), F.lit(0)), "type": F.coalesce(F.col("type"), F.lit(5)),
        "level": F.coalesce(F.col("level"), lvl), "score": F.coalesce(F.col("score"), F.lit(100.0)),
        "time": F.coalesce(F.col("time"), F.lit(30)), "sequence": F.coalesce(F.col("sequence"), F.lit(0)),
        "title_lang": full_tl, "parts": parts}).drop("_tn", "_num")


def _split_template(t: str) -> list[str]:
    a, b = t.split("{n}")
    return [x for x in (a, "{n}", b) if x != ""]


def ai_skill_split(exams: DataFrame, second_decrement: bool = True, first_decrement: bool = False) -> DataFrame:
    """Skill exams of AI exams, whose titles E9 has decremented once (or does here,
    with ``first_decrement``); the reference decrements the skill titles a second
    time, kept by default.

    Titles are built and decremented once per exam, before ``posexplode`` and with no
    shuffle: the fixed skill suffixes contain none of the decrement patterns, so
    decrementing ``title + " - " + suffix`` equals decrementing ``title`` and appending."""
    if first_decrement:
        exams = exams.withColumns({"title": decrement_title("title"),
                                   "title_lang": F.transform_values("title_lang", lambda k, v: decrement_title(v))})
    parsed = exams.select(F.col("id").alias("exam_id"), "level", "parts", title_number("title").alias("_tn"),
                          _parsed_langs("title_lang").alias("_tl")).filter(F.col("_tn").isNotNull())
    base_title = F.concat(F.lit("Test "), F.col("_tn").cast("string"))
    base_langs = F.transform_values("_tl", lambda k, x: F.when(
        (k == "ko") & x["ko"].isNotNull(), F.concat(x["n"].cast("string"), F.lit(" 번 시험지"))).otherwise(x["text"]))
    per_exam = parsed.select("exam_id", "level", "parts", base_title.alias("_t"), F.coalesce(base_langs, _no_titles()).alias("_tl"))
    if second_decrement:
        per_exam = per_exam.withColumns({"_t": decrement_title("_t"),
                                         "_tl": F.transform_values("_tl", lambda k, v: decrement_title(v))})
    p = per_exam.select("exam_id", "level", "_t", "_tl", F.posexplode("parts").alias("part_pos", "part")).filter(
        F.col("part.name").isin(SKILLS))
    skill = F.col("part.name")
    return p.select("exam_id", "part_pos", "level",
                    F.concat(F.col("_t"), F.lit(" - "), skill).alias("title"),
                    F.transform_values("_tl", lambda k, v: F.concat(v, F.lit(" - "), skill_suffix(skill, k))).alias("title_lang"),
                    F.array("part").alias("parts"), F.coalesce(F.col("part.time"), F.lit(30)).alias("time"),
                    F.lit(100).alias("score"), F.lit(0).alias("active"), F.lit(5).alias("type"),
                    F.lit(0).alias("sequence"))


def flatten_groups_json(groups_json) -> Column:
    """Ragged ``groups`` (JSON text or parsed) flattened one level; elements
    come back as JSON text.  Invalid JSON gives an empty list."""
    v = F.try_parse_json(_c(groups_json))
    arr = F.when(F.schema_of_variant(v).startswith("ARRAY"), v.cast("array<variant>")).otherwise(
        F.array().cast("array<variant>"))
    nested = F.transform(arr, lambda e: F.when(F.schema_of_variant(e).startswith("ARRAY"),
                                                e.cast("array<variant>")).otherwise(F.array(e)))
    return F.transform(F.flatten(nested), lambda e: F.to_json(e))


def parse_exam_json(df: DataFrame, parts_schema: str) -> DataFrame:
    """``parts``/``groups``/``title_lang`` given as JSON text are parsed;
    an unparsable ``parts`` drops the exam, bad ``groups`` -> [], bad
    ``title_lang`` -> {}."""
    parts = F.from_json(F.col("parts"), parts_schema, {"mode": "PERMISSIVE"})
    ok_parts = F.try_parse_json(F.col("parts")).isNotNull()
    tl = F.when(F.try_parse_json("title_lang").isNotNull(),
                F.from_json("title_lang", "map<string,string>")).otherwise(F.create_map().cast("map<string,string>"))
    groups = F.when(F.try_parse_json("groups").isNotNull(), F.col("groups")).otherwise(F.lit("[]"))
    return df.filter(ok_parts).withColumns({"parts": parts, "title_lang": tl, "groups": groups})
