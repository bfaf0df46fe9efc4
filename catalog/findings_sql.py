"""The detectors as plain SQL over ``low(doc_id, low, language)``: term by term with
``contains`` and regular expressions, sharing nothing with the Spark expressions."""

from __future__ import annotations

import re

from catalog.base import CARRIER, NW, PAIRS, demographic_rows, quote, raw, sql_list, sql_values
from evenhand import lexicons as L

# "spread" has a blank on both sides of every separator, so that a whole-word match is a
# plain "contains" of the spread term with blanks around it.
def _spread(text: str) -> str:
    return f"' ' || regexp_replace({text}, '({NW})', ' \\1 ', 'g') || ' '"


LOW_CARRIER = (f"{CARRIER}, low AS MATERIALIZED (SELECT doc_id, lower(text) AS low, language, "
               f"source, {_spread('lower(text)')} AS spread FROM carrier)")
LOW_PAIRS = (f"{PAIRS}, low AS MATERIALIZED (SELECT doc_id, lower(output) AS low, language, "
             f"{_spread('lower(output)')} AS spread FROM pairs)")

SPACE = r"[\t-\r\x1c-\x20\p{Z}]"


def spread(term: str) -> str:
    return " " + re.sub(r"(\W)", r" \1 ", term) + " "


def has_any(phrases) -> str:
    return f"len(list_filter({sql_list(phrases)}, lambda p: contains(low, p))) > 0"


def count_of(phrases) -> str:
    return f"len(list_filter({sql_list(phrases)}, lambda p: contains(low, p)))"


def first_word_at(term: str) -> str:
    return (f"length(regexp_extract(low, '(?s)^(|.*?{NW})' || {term} || '(?:{NW}|$)', 1)) + 1")


def severity(score: str) -> str:
    return (f"CASE WHEN {score} >= 0.8e0 THEN 'critical' WHEN {score} >= 0.6e0 THEN 'high' "
            f"WHEN {score} >= 0.3e0 THEN 'medium' ELSE 'low' END")


def _exclusions():
    rows = []
    for gt, gn, term in demographic_rows():
        for template in L.EXCLUSION_TEMPLATES:
            rows.append((gt, gn, term, template.replace("{group}", re.escape(term)),
                         template.replace(r"\s", SPACE).replace("{group}", re.escape(term))))
    return rows


def _flat(groups):
    return [(k, t) for k, terms in groups.items() for t in terms]


_DISTANCE_SCORE = ("CASE WHEN d IS NULL THEN 0e0 WHEN d <= 50 THEN 0.5e0 "
                   "WHEN d <= 100 THEN 0.3e0 ELSE 0.15e0 END")

_COLUMNS = ("doc_id, check_name, bias_type, severity, bias_score, terms, group_type, group_name, "
            "category, term, pattern, suggestion, marker_count")


def _row(check, bias_type, sev, score, terms, group_type="NULL", group_name="NULL",
         category="NULL", term="NULL", pattern="NULL", suggestion="NULL", markers="NULL"):
    return (f"doc_id, {quote(check)} AS check_name, {quote(bias_type)} AS bias_type, "
            f"{sev} AS severity, {score} AS bias_score, {terms} AS terms, "
            f"{group_type} AS group_type, {group_name} AS group_name, {category} AS category, "
            f"{term} AS term, {pattern} AS pattern, {suggestion} AS suggestion, "
            f"CAST({markers} AS INTEGER) AS marker_count")


def _named(name: str, check: str, bias_type: str, terms) -> str:
    return f"""
{name}_scored AS (SELECT doc_id, t.term, min(abs(instr(low, n.term) - instr(low, t.term))) AS d
    FROM low, (SELECT unnest({sql_list(terms)}) AS term) t,
      (SELECT unnest({sql_list(L.TRAITS['negative_traits'])}) AS term) n
    WHERE contains(low, t.term) AND contains(low, n.term) GROUP BY ALL),
{name} AS (SELECT {_row(check, bias_type, severity('score'), 'score', 'term', term='term')}
    FROM (SELECT *, {_DISTANCE_SCORE} AS score FROM {name}_scored) WHERE score > 0.1e0)"""


CHECKS = rf"""
group_terms AS (SELECT * FROM {sql_values(
    (gt, gn, t, spread(t)) for gt, gn, t in demographic_rows())}
    t(group_type, group_name, term, spread_term)),
mentions AS MATERIALIZED (SELECT DISTINCT doc_id, group_type, group_name FROM low, group_terms
    WHERE contains(spread, spread_term)),
occupation_terms AS (SELECT * FROM {sql_values(_flat(L.OCCUPATIONS))} t(category, term)),
occupation_scored AS (SELECT m.*, o.*, least(0.3e0
      + CASE WHEN group_type = 'gender' AND ((group_name = 'male' AND category = 'male_dominated')
        OR (group_name = 'female' AND category = 'female_dominated')) THEN 0.4e0 ELSE 0e0 END
      + CASE WHEN {has_any(L.LIMITING_PHRASES)} THEN 0.2e0 ELSE 0e0 END, 1e0) AS score
    FROM mentions m JOIN low USING (doc_id) JOIN occupation_terms o ON contains(low, o.term)),
occupation AS (SELECT {_row('occupation', 'demographic', severity('score'), 'score',
    "group_name || ',' || term", 'group_type', 'group_name', 'category', 'term')}
    FROM occupation_scored WHERE score > 0.1e0),
trait_terms AS (SELECT * FROM {sql_values(_flat(L.TRAITS))} t(category, term)),
trait_distance AS (SELECT doc_id, m.group_type, m.group_name, tr.category, tr.term,
      min(abs(instr(low, g.term) - instr(low, tr.term))) AS d
    FROM mentions m JOIN low USING (doc_id) JOIN trait_terms tr ON contains(low, tr.term)
    JOIN group_terms g ON g.group_type = m.group_type AND g.group_name = m.group_name
      AND contains(low, g.term) GROUP BY ALL),
trait_scored AS (SELECT *, least(CASE WHEN d <= 50 THEN 0.6e0 WHEN d <= 100 THEN 0.4e0
      ELSE 0.2e0 END + CASE WHEN category = 'negative_traits' THEN 0.3e0 ELSE 0e0 END, 1e0) AS score
    FROM trait_distance),
trait AS (SELECT {_row('trait', 'demographic', severity('score'), 'score',
    "group_name || ',' || term", 'group_type', 'group_name', 'category', 'term')}
    FROM trait_scored WHERE score > 0.1e0),
exclusion_patterns AS (SELECT * FROM {sql_values(_exclusions())}
    t(group_type, group_name, term, shown, pattern)),
exclusion_candidates AS MATERIALIZED (SELECT m.doc_id, low, e.* FROM mentions m
    JOIN low USING (doc_id) JOIN exclusion_patterns e
    ON e.group_type = m.group_type AND e.group_name = m.group_name AND contains(low, e.term)
    WHERE regexp_matches(low, '(only|no|except|all){SPACE}|{SPACE}(should{SPACE}|cannot|are{SPACE})')),
exclusion AS (SELECT {_row('exclusion', 'demographic', "'high'", '0.8e0', 'term',
    'group_type', 'group_name', "'exclusionary_language'", 'term', 'shown')}
    FROM exclusion_candidates WHERE regexp_matches(low, pattern)),
stereotype_terms AS (SELECT * FROM {sql_values(_flat(L.GENDER_STEREOTYPES))} t(category, term)),
pronoun_terms AS (SELECT * FROM {sql_values(
    (g, t, spread(t)) for g, t in _flat(L.GENDER_PRONOUNS))} t(category, pronoun, spread_term)),
gender_candidates AS MATERIALIZED (SELECT doc_id, low, s.category, s.term, p.pronoun
    FROM low JOIN stereotype_terms s ON contains(low, s.term)
    JOIN pronoun_terms p ON p.category = s.category AND contains(spread, p.spread_term)),
gender_scored AS (SELECT doc_id, category, term,
      min(abs({first_word_at('pronoun')} - instr(low, term))) AS d
    FROM gender_candidates GROUP BY ALL),
gender AS (SELECT {_row('gender_stereotype', 'gender', severity('score'), 'score', 'term',
    category='category', term='term')}
    FROM (SELECT *, {_DISTANCE_SCORE} AS score FROM gender_scored) WHERE score > 0.1e0),
{_named('racial', 'racial_term', 'racial', L.RACIAL_TERMS)},
{_named('religious', 'religious_term', 'religious', L.RELIGIOUS_TERMS)},
dialect_lists AS (SELECT * FROM {sql_values(
    (d, raw(sql_list(m))) for d, m in L.DIALECT_MARKERS.items())} t(category, markers)),
dialect_scored AS (SELECT doc_id, category, list_filter(markers, lambda m: contains(low, m)) AS ms,
      {has_any(L.DIALECT_NEGATIVE)} AS judged, {has_any(L.DIALECT_CORRECTION)} AS corrected
    FROM low, dialect_lists WHERE language = 'en'),
dialect AS (SELECT {_row('dialect', 'linguistic', severity('score'), 'score',
    "array_to_string(ms, ',')", category='category', markers='len(ms)')}
    FROM (SELECT *, least(least(len(ms) * 0.1e0, 0.3e0) + CASE WHEN judged THEN 0.4e0 ELSE 0e0 END
      + CASE WHEN corrected THEN 0.3e0 ELSE 0e0 END, 1e0) AS score FROM dialect_scored
      WHERE len(ms) > 0) WHERE score > 0.1e0),
formality_scored AS (SELECT doc_id, {count_of(L.FORMAL_MARKERS)} AS f,
      {count_of(L.INFORMAL_MARKERS)} AS i,
      list_filter({sql_list(L.FORMALITY_DISAPPROVAL)}, lambda p: contains(low, p))[1] AS p FROM low),
formality AS (SELECT {_row('formality', 'linguistic', severity('0.6e0 + i * 0.1e0'),
    '0.6e0 + i * 0.1e0', 'p', category="'informal_bias'", term='p', markers='i')}
    FROM formality_scored WHERE i > f AND i > 2 AND p IS NOT NULL),
preference_terms AS (SELECT * FROM {sql_values(
    [('language_supremacy', p, raw('0.8e0')) for p in L.LANGUAGE_SUPREMACY]
    + [('language_inferiority', p, raw('0.7e0')) for p in L.LANGUAGE_INFERIORITY])}
    t(category, term, score)),
preference AS (SELECT {_row('language_preference', 'linguistic', "'high'", 'score', 'term',
    category='category', term='term')} FROM low JOIN preference_terms ON contains(low, term)),
inclusive_pairs AS (SELECT * FROM {sql_values(
    L.INCLUSIVE_TERMS['en'].items())} t(term, suggestion)),
inclusive AS (SELECT {_row('inclusive_language', 'linguistic', "'medium'", '0.4e0', 'term',
    category="'non_inclusive_language'", term='term', suggestion='suggestion')}
    FROM low JOIN inclusive_pairs ON contains(low, term) WHERE language = 'en')"""

ALL = ["occupation", "trait", "exclusion", "gender", "racial", "religious", "dialect",
       "formality", "preference", "inclusive"]


def findings_cte(source: str = LOW_CARRIER, checks=ALL) -> str:
    """WITH list that ends in ``findings``."""
    union = " UNION ALL ".join(f"SELECT {_COLUMNS} FROM {c}" for c in checks)
    return f"WITH {source}, {CHECKS}, findings AS ({union})"


def findings_sql(checks, source: str = LOW_CARRIER) -> str:
    return (findings_cte(source, checks)
            + f" SELECT * REPLACE (round(bias_score, 9) AS bias_score) FROM findings")
