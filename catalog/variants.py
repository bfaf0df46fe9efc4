"""Counterfactual queries.  Picks are ``doc_id % n`` on both sides, because the engines hash
differently."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from catalog.base import CARRIER, NW, sql_list, sql_values
from evenhand import lexicons as L
from evenhand.operators import counterfactual as X


def modulo_pick(key, salt, size):
    return F.pmod(key, F.lit(size))


def _shown(df):
    return df.select("doc_id", "method", "target", F.md5("variant").alias("digest"))


def _swap(*methods):
    return lambda spark, sf: _shown(X.substitutions(
        B.carrier(spark, sf).select("doc_id", "text"), methods, pick=modulo_pick))


def _counterfactuals(spark, sf):
    return _counter(spark, sf).select("doc_id", "variant_rank", "method", "target",
                                      F.md5("variant").alias("digest"))


def _counter(spark, sf):
    return X.counterfactuals(B.carrier(spark, sf).select("doc_id", "text"), pick=modulo_pick)


def _skew(spark, sf):
    return B.carrier(spark, sf).select(
        "doc_id", F.round(X.skew_score(F.lower("text")), 9).alias("score"))


def _differences(spark, sf):
    return X.counterfactual_differences(B.carrier(spark, sf), pick=modulo_pick)


def _per_text(spark, sf):
    return _differences(spark, sf).select(
        "doc_id", *[F.round(c, 9).alias(c) for c in ("own_score", "variant_score", "difference")])


def _analysis(spark, sf):
    return X.counterfactual_analysis(_differences(spark, sf)).select(
        "texts", F.round("average_bias_change", 9).alias("average_bias_change"),
        "significant_changes")


def _effectiveness(spark, sf):
    return X.effectiveness(_differences(spark, sf)).select(
        F.round("effectiveness", 9).alias("effectiveness"))


def _sentences(spark, sf):
    """Names are customers, attributes their nations, professions their segments."""
    nations = B.table(spark, sf, "nation").select("n_nationkey", "n_name")
    slots = B.table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("n_name").alias("attribute"), F.lower("c_mktsegment").alias("profession"))
    return X.template_sentences(slots).select(
        "id", "adjective", "template", "sentence")


GENDERS = ["male", "female", "neutral"]
RACES = list(L.ETHNIC_NAMES)


def _paired(spark, sf):
    names = B.table(spark, sf, "customer").select(
        F.get(F.array(*[F.lit(g) for g in GENDERS]), (F.col("c_custkey") % 3).cast("int"))
        .alias("gender"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    ranked = names.withColumn("ord", F.floor(F.col("k") / 3) - F.when(F.col("k") % 3 == 0, 1)
                              .otherwise(0)).drop("k")
    return X.paired_cases(ranked).select(
        "original_gender", "variation_gender", "profession", "original", "variation")


def _intersection(spark, sf):
    people = B.table(spark, sf, "supplier").select(
        F.get(F.array(*[F.lit(g) for g in GENDERS[:2]]), (F.col("s_suppkey") % 2).cast("int"))
        .alias("gender"),
        F.get(F.array(*[F.lit(r) for r in RACES]), (F.col("s_suppkey") % len(RACES)).cast("int"))
        .alias("race"),
        F.col("s_suppkey").alias("ord"), F.col("s_name").alias("name"))
    return X.intersection_cases(people).select(
        "gender", "race", "variation_race", "profession", "original", "variation")


QUERIES = {
    "swap_gender": _swap("gender"),
    "swap_names": _swap("name"),
    "swap_race_terms": _swap("race"),
    "swap_religion_terms": _swap("religion"),
    "direct_substitutions": _swap(*X.DIRECT),
    "template_sentences": _sentences,
    "counterfactuals": _counterfactuals,
    "skew_score": _skew,
    "counterfactual_differences": _per_text,
    "counterfactual_analysis": _analysis,
    "effectiveness": _effectiveness,
    "paired_cases": _paired,
    "intersection_cases": _intersection,
}

# -- SQL --------------------------------------------------------------------

_TEMPLATE_ROWS = sql_values(
    (t, t.replace("{action}", "succeed").replace("{verb}", "helps").replace("{object}", "others")
     .replace("{qualification}", "qualified").replace("{context}", "leadership")
     .replace("{characteristic}", "{adjective}").replace("{trait}", "{adjective}"))
    for t in L.TEMPLATES)


def _replace_word(text: str, source: str, to: str) -> str:
    """Whole-word replacement without lookaround: done twice, because two occurrences can
    share the separator between them."""
    escaped = source.replace(".", "\\.")
    end = f"({NW}|$)" if source[-1].isalnum() else "()"
    for _ in range(2):
        text = f"regexp_replace({text}, '(^|{NW}){escaped}{end}', '\\1{to}\\2', 'g')"
    return text


def _gender_sql() -> str:
    selects = []
    for target in L.SWAP_PRONOUNS:
        text = "text"
        for source, to in L.SWAP_PRONOUNS[target].items():
            text = _replace_word(text, source, to)
            text = _replace_word(text, source.capitalize(), to.capitalize())
        for source, to in L.SWAP_TITLES[target].items():
            text = _replace_word(text, source, to.replace("'", "''"))
        selects.append(f"SELECT doc_id, text, 'gender' AS method, '{target}' AS target, "
                       f"'' AS word, {text} AS variant FROM carrier")
    return " UNION ALL ".join(selects)


def _names_sql() -> str:
    lists = {f"{g}_names": n for g, n in L.GENDER_NAMES.items()} | L.ETHNIC_NAMES
    rows = sql_values((t, B.raw(sql_list(n))) for t, n in lists.items())
    return f"""SELECT doc_id, text, 'name' AS method, l.target AS target, name AS word,
      replace(text, name, names[(doc_id % len(names)) + 1]) AS variant
      FROM (SELECT doc_id, text, unnest(list_distinct(regexp_extract_all(
          regexp_replace(text, '({NW})', '\\1\\1', 'g'),
          '(?:^|{NW})([A-Z][a-z]+)(?:{NW}|$)', 1))) AS name FROM carrier),
        {rows} l(target, names)"""


def _race_sql() -> str:
    selects = []
    for race, terms in L.RACE_SWAP_TERMS.items():
        for target in L.RACE_SWAP_TERMS:
            if target == race:
                continue
            text = "text"
            for _ in range(2):
                text = (f"regexp_replace({text}, '(?i)(^|{NW})(?:{'|'.join(terms)})({NW}|$)', "
                        f"'\\1{target}\\2', 'g')")
            selects.append(f"SELECT doc_id, text, 'race' AS method, '{race}>{target}' AS target, "
                           f"'' AS word, {text} AS variant FROM carrier")
    return " UNION ALL ".join(selects)


def _religion_sql() -> str:
    rows = [(f"{a}>{b}", term, others[n])
            for a, terms in L.RELIGION_SWAP_TERMS.items() for n, term in enumerate(terms)
            for b, others in L.RELIGION_SWAP_TERMS.items() if a != b]
    rows = [(t, x, y, x.capitalize(), y.capitalize()) for t, x, y in rows]
    return f"""SELECT doc_id, text, 'religion' AS method, t.target AS target, term AS word,
      replace(replace(text, term, other), cap, other_cap) AS variant
      FROM carrier, {sql_values(rows)} t(target, term, other, cap, other_cap)
      WHERE contains(lower(text), lower(term))"""


def _template_sql() -> str:
    male, jobs = sql_list(L.GENDER_NAMES["male"]), sql_list(L.PROFESSIONS)
    return f"""SELECT *, variant AS word FROM (SELECT doc_id, text, 'template' AS method, a.v AS target,
      replace(replace(replace(replace(t.body, '{{attribute}}', a.v), '{{adjective}}', j.v),
        '{{name}}', ({male})[(doc_id % 20) + 1]), '{{profession}}', ({jobs})[(doc_id % 12) + 1])
        AS variant
      FROM carrier, {_TEMPLATE_ROWS} t(template, body),
        (SELECT unnest({sql_list(L.TEMPLATE_ATTRIBUTES)}) AS v) a,
        (SELECT unnest({sql_list(X.ALL_ADJECTIVES)}) AS v) j)"""


_PARTS = {"gender": _gender_sql(), "name": _names_sql(), "race": _race_sql(),
          "religion": _religion_sql(), "template": _template_sql()}


def _variants_cte(methods, carrier: str = CARRIER) -> str:
    union = " UNION ALL BY NAME ".join(f"({_PARTS[m]})" for m in methods)
    return (f"WITH {carrier}, variants AS (SELECT doc_id, method, target, word, variant FROM ({union}) "
            "WHERE variant <> text)")


def _swap_sql(*methods) -> str:
    return (f"{_variants_cte(methods)} SELECT doc_id, method, target, md5(variant) AS digest "
            "FROM variants")


def _skew_sql(text: str) -> str:
    p = f"len(list_filter({sql_list(L.SKEW_WORDS['positive'])}, lambda w: contains(lower({text}), w)))"
    n = f"len(list_filter({sql_list(L.SKEW_WORDS['negative'])}, lambda w: contains(lower({text}), w)))"
    return f"CASE WHEN {p} + {n} > 0 THEN abs({p} - {n}) / ({p} + {n}) ELSE 0e0 END"


def ranked_sql(carrier: str = CARRIER) -> str:
    return f"""{_variants_cte(_PARTS, carrier)},
    firsts AS (SELECT *, row_number() OVER (PARTITION BY doc_id, variant
      ORDER BY method, target, word) AS copy FROM variants),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id
      ORDER BY method, target, word) AS variant_rank FROM firsts WHERE copy = 1)"""


def differences_sql(carrier: str = CARRIER) -> str:
    """WITH list that ends in ``differences``."""
    return f"""{ranked_sql(carrier)},
    scores AS (SELECT doc_id, avg({_skew_sql('variant')}) AS variant_score FROM ranked
      GROUP BY doc_id),
    differences AS (SELECT doc_id, own_score, variant_score,
      abs(own_score - variant_score) AS difference FROM scores JOIN (SELECT doc_id,
        {_skew_sql('text')} AS own_score FROM carrier) USING (doc_id))"""


_RANKED, _DIFFERENCES = ranked_sql(), differences_sql()

SQL = {
    "swap_gender": _swap_sql("gender"),
    "swap_names": _swap_sql("name"),
    "swap_race_terms": _swap_sql("race"),
    "swap_religion_terms": _swap_sql("religion"),
    "direct_substitutions": _swap_sql(*X.DIRECT),
    "template_sentences": f"""SELECT c_custkey AS id, j.v AS adjective, t.template AS template,
        replace(replace(replace(replace(t.body, '{{attribute}}', n_name), '{{adjective}}', j.v),
          '{{name}}', c_name), '{{profession}}', lower(c_mktsegment)) AS sentence
        FROM customer JOIN nation ON c_nationkey = n_nationkey, {_TEMPLATE_ROWS} t(template, body),
          (SELECT unnest({sql_list(X.ALL_ADJECTIVES)}) AS v) j""",
    "counterfactuals": f"""{_RANKED} SELECT doc_id, variant_rank, method, target,
        md5(variant) AS digest FROM ranked""",
    "skew_score": f"WITH {CARRIER} SELECT doc_id, round({_skew_sql('text')}, 9) AS score "
                  "FROM carrier",
    "counterfactual_differences": f"""{_DIFFERENCES} SELECT doc_id,
        round(own_score, 9) AS own_score, round(variant_score, 9) AS variant_score,
        round(difference, 9) AS difference FROM differences""",
    "counterfactual_analysis": f"""{_DIFFERENCES} SELECT count(*) AS texts,
        round(avg(difference), 9) AS average_bias_change,
        count(*) FILTER (difference > 0.1e0) AS significant_changes FROM differences""",
    "effectiveness": f"""{_DIFFERENCES} SELECT round(avg(CASE WHEN difference > 0.1e0 THEN 1e0
        ELSE 0e0 END), 9) AS effectiveness FROM differences""",
    "paired_cases": f"""WITH names AS (SELECT ({sql_list(GENDERS)})[(c_custkey % 3) + 1] AS gender,
        (c_custkey - CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE c_custkey % 3 END) // 3 AS ord,
        c_name AS name FROM customer),
        sizes AS (SELECT gender, count(*) AS n FROM names GROUP BY gender)
        SELECT a.gender AS original_gender, b.gender AS variation_gender, p.v AS profession,
          a.name || ' is applying for a ' || p.v || ' position.' AS original,
          b.name || ' is applying for a ' || p.v || ' position.' AS variation
        FROM names a JOIN sizes s ON s.gender <> a.gender
        JOIN names b ON b.gender = s.gender AND b.ord = a.ord % s.n,
        (SELECT unnest({sql_list(L.PROFESSIONS)}) AS v) p""",
    "intersection_cases": f"""WITH lists AS (SELECT * FROM {sql_values(
        (r, B.raw(sql_list(L.ETHNIC_NAMES[r]))) for r in RACES)} t(race, names)),
        people AS (SELECT ({sql_list(GENDERS[:2])})[(s_suppkey % 2) + 1] AS gender,
          ({sql_list(RACES)})[(s_suppkey % {len(RACES)}) + 1] AS race, s_suppkey AS ord, s_name AS name,
          ({sql_list(L.PROFESSIONS)})[(s_suppkey % 12) + 1] AS profession FROM supplier)
        SELECT gender, a.race AS race, b.race AS variation_race, profession,
          name || ' ' || a.names[(ord % len(a.names)) + 1] || ' is a qualified ' || profession
            || '.' AS original,
          name || ' ' || b.names[(ord % len(b.names)) + 1] || ' is a qualified ' || profession
            || '.' AS variation
        FROM people JOIN lists a ON a.race = people.race JOIN lists b ON b.race <> a.race""",
}

