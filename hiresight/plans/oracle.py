"""DuckDB SQL for the correctness oracle.

These strings are written independently of the Spark code: plain window
functions and CASE chains over the driver tables, in DuckDB's dialect.  Only
the fixed values (keywords, lexicon, city keys) are shared, so a wrong Spark
operator cannot hide behind an equally wrong oracle.
"""

from __future__ import annotations

from ..functions.constants import (CITY_KEYS, CITY_KEYS_ADVANCED, CITY_MULTIPLIERS, CITY_MULTIPLIER_DEFAULT,
                                   CITY_REJECT_WORDS, COMPANY_SIZE_BANDS, EXPERIENCE_LEVEL_WORDS,
                                   HIGH_VALUE_SKILLS, IT_KEYWORDS, SKILL_COMBOS, VALID_IT_SKILLS)
from ..functions.skills import pattern_pairs, word_only_abbreviations
from ..sources.postings import RAW_POSTINGS_SQL


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_instr(expr: str, needles) -> str:
    return "(" + " OR ".join(f"instr({expr}, {q(k)}) > 0" for k in needles) + ")"


def str_list(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def title_case(expr: str) -> str:
    """Spark initcap: upper first letter of each space-separated word, lower the rest."""
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def city_sql(expr: str, keys=CITY_KEYS) -> str:
    s = f"lower(trim({expr}))"
    whens = " ".join(f"WHEN instr({s}, {q(k)}) > 0 THEN {q(v)}" for k, v in keys)
    return (f"(CASE WHEN {expr} IS NULL OR {expr} = '' THEN 'Other' {whens} "
            f"WHEN {s} = '' THEN 'Other' ELSE {title_case(s)} END)")


def city_advanced_sql(expr: str) -> str:
    s = f"lower(trim({expr}))"
    whens = " ".join(f"WHEN instr({s}, {q(k)}) > 0 THEN {q(v)}" for k, v in CITY_KEYS_ADVANCED)
    nwords = f"len(list_filter(string_split({s}, ' '), lambda w: w <> ''))"
    return (f"(CASE WHEN {expr} IS NULL OR {expr} = '' THEN 'Other' "
            f"WHEN {any_instr(s, CITY_REJECT_WORDS)} THEN 'Other' "
            f"WHEN regexp_matches({s}, '^[0-9]') THEN 'Other' {whens} "
            f"WHEN {nwords} <= 3 AND NOT regexp_matches({s}, '[0-9]') THEN {title_case(s)} ELSE 'Other' END)")


def years_sql(expr: str) -> str:
    s = f"lower(trim({expr}))"
    nums = f"list_transform(regexp_extract_all({s}, '(\\d+(?:\\.\\d+)?)', 1), lambda x: CAST(x AS DOUBLE))"
    whens = " ".join(f"WHEN instr({s}, {q(k)}) > 0 THEN {float(v)}" for k, v in EXPERIENCE_LEVEL_WORDS)
    return (f"(CASE WHEN {expr} IS NULL OR {expr} = '' THEN 2.0 {whens} "
            f"WHEN len({nums}) >= 2 THEN ({nums}[1] + {nums}[2]) / 2 "
            f"WHEN len({nums}) = 1 THEN {nums}[1] ELSE 2.0 END)")


def level_sql(expr: str) -> str:
    return (f"(CASE WHEN {expr} < 1 THEN 'Fresher' WHEN {expr} < 3 THEN 'Junior' "
            f"WHEN {expr} < 5 THEN 'Middle' WHEN {expr} < 8 THEN 'Senior' ELSE 'Expert' END)")


def midpoint_sql(lo: str, hi: str) -> str:
    return (f"(CASE WHEN {lo} > 0 AND {hi} > 0 THEN round(({lo} + {hi}) / 2 / 1000000, 1) "
            f"WHEN {lo} > 0 THEN round({lo} / 1000000, 1) WHEN {hi} > 0 THEN round({hi} / 1000000, 1) END)")


def norm_sql(expr: str) -> str:
    return (f"regexp_replace(regexp_replace(lower({expr}), '[^\\p{{L}}\\p{{N}}_\\s-]', ' ', 'g'), "
            f"'\\s+', ' ', 'g')")


def skills_sql(expr: str, whitelist=None) -> str:
    pairs = pattern_pairs(whitelist)
    lex = "[" + ", ".join(f"{{'p': {q(p)}, 's': {q(s)}}}" for p, s in pairs) + "]"
    n = norm_sql(expr)
    found = f"list_transform(list_filter({lex}, lambda e: instr({n}, e.p) > 0), lambda e: e.s)"
    for abbr, full in word_only_abbreviations(whitelist):
        found = (f"list_concat({found}, CASE WHEN list_contains(string_split({n}, ' '), {q(abbr)}) "
                 f"THEN [{q(full)}] ELSE []::VARCHAR[] END)")
    return (f"(CASE WHEN {expr} IS NULL OR {expr} = '' THEN []::VARCHAR[] "
            f"ELSE list_sort(list_distinct({found})) END)")


def word_pattern(name: str) -> str:
    """RE2 pattern of a name with a word boundary at both ends (Unicode words)."""
    import re
    edge = lambda c, ends: f"({ends}|[^\\p{{L}}\\p{{N}}_])" if c.isalnum() or c == "_" else "[\\p{L}\\p{N}_]"
    return edge(name[0], "^") + re.escape(name) + edge(name[-1], "$")


def names_table(alias: str, names) -> str:
    return f"{alias}(name, pat) AS (VALUES " + ", ".join(f"({q(n)}, {q(word_pattern(n))})" for n in dict.fromkeys(names)) + ")"


def posting_ctes() -> str:
    return f"""raw AS ({RAW_POSTINGS_SQL}),
posting AS (
  SELECT post_id, CASE WHEN source = 'feed_a' THEN 0 ELSE 1 END AS source_rank, source_url,
         coalesce(title, '') AS title, coalesce(company, '') AS company, coalesce(city_raw, '') AS city_raw,
         CASE WHEN isnan(salary_min) THEN NULL ELSE salary_min END AS salary_min,
         CASE WHEN isnan(salary_max) THEN NULL ELSE salary_max END AS salary_max,
         coalesce(exp_raw, '') AS exp_raw,
         regexp_replace(' ' || coalesce(job_description, '') || ' ' || coalesce(qualifications, ''),
                        '^\\s+|\\s+$', '', 'g') AS description,
         coalesce(working_form, '') AS working_form, source
  FROM raw)"""


def clean_ctes() -> str:
    """CTEs posting .. clean (the clean_posting layer is ``clean``)."""
    return posting_ctes() + f""",
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY title, company ORDER BY source_rank, post_id) AS rn FROM posting)
  WHERE rn = 1),
domain AS (SELECT * FROM dedup WHERE {any_instr("lower(title || ' ' || description)", IT_KEYWORDS)}),
sal AS (SELECT *, {midpoint_sql("salary_min", "salary_max")} AS salary FROM domain),
filled AS (SELECT * REPLACE (coalesce(salary, (SELECT coalesce(median(salary), 20) FROM sal)) AS salary) FROM sal),
parsed AS (
  SELECT *, {years_sql("exp_raw")} AS exp_years, {city_sql("city_raw")} AS city,
         {skills_sql("description", set(VALID_IT_SKILLS))} AS skills,
         CAST(coalesce(regexp_matches(lower(description), 'remote|work from home|wfh|hybrid'), false) AS INTEGER) AS remote,
         CAST(coalesce(regexp_matches(lower(description), 'english|ielts|toeic|toefl'), false) AS INTEGER) AS english
  FROM filled),
clean AS (
  SELECT *, CAST(len(skills) AS INTEGER) AS num_skills, {level_sql("exp_years")} AS level
  FROM parsed WHERE salary BETWEEN 5 AND 100)"""


def enriched_ctes() -> str:
    bands = " ".join(
        f"WHEN company_size > {lo} {'AND company_size <= ' + str(hi) if hi is not None else ''} THEN {q(lab)}"
        for lo, hi, lab in COMPANY_SIZE_BANDS)
    mult = " ".join(f"WHEN city = {q(c)} THEN {m}" for c, m in CITY_MULTIPLIERS)
    combos = ", ".join(
        f"CAST(list_has_all(skills, {str_list(sk)}) AS INTEGER) AS combo_{name}" for name, sk in SKILL_COMBOS)
    hv = [s for s in HIGH_VALUE_SKILLS if s in VALID_IT_SKILLS]
    return clean_ctes() + f""",
company_counts AS (SELECT company, count(*) AS n FROM clean GROUP BY company),
sized AS (
  SELECT c.*, cc.n AS company_size FROM clean c JOIN company_counts cc ON c.company = cc.company),
enr1 AS (
  SELECT *, CASE {bands} END AS company_size_category,
         CAST(company_size >= (SELECT quantile_cont(n, 0.75) FROM company_counts) AS INTEGER) AS is_big_company,
         CAST(CASE {mult} ELSE {CITY_MULTIPLIER_DEFAULT} END AS DOUBLE) AS city_multiplier,
         CAST(city IN ('Ho Chi Minh City', 'Hanoi') AS INTEGER) AS is_big_city,
         {combos},
         CAST(len(list_intersect(skills, {str_list(hv)})) AS INTEGER) AS num_high_value_skills
  FROM sized),
enriched AS (
  SELECT *, exp_years * num_skills AS exp_skill_interaction,
         exp_years * num_high_value_skills AS exp_high_value,
         exp_years * exp_years AS exp_squared,
         remote * english AS remote_english, remote * is_big_city AS remote_big_city,
         salary / (num_skills + 1) AS salary_per_skill
  FROM enr1)"""


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


# ----------------------------------------------------------------- parsers
from ..functions.constants import (FROM_WORDS_A, FROM_WORDS_B, MILLION_WORDS,  # noqa: E402
                                   NEGOTIABLE_WORDS_A, NEGOTIABLE_WORDS_B, THOUSAND_WORDS,
                                   UP_TO_WORDS_A, UP_TO_WORDS_B)


def _pick(raw: str, t: str, vals: str, neg: str, up_to, from_words):
    first, second = f"CAST({vals}[1] AS VARCHAR)", f"CAST({vals}[2] AS VARCHAR)"
    blank = f"({raw} IS NULL OR {raw} = '' OR {neg} OR len({vals}) = 0)"
    lo = (f"(CASE WHEN {blank} THEN '' WHEN len({vals}) >= 2 THEN {first} "
          f"WHEN {any_instr(t, up_to)} THEN '' ELSE {first} END)")
    hi = (f"(CASE WHEN {blank} THEN '' WHEN len({vals}) >= 2 THEN {second} "
          f"WHEN {any_instr(t, up_to)} THEN {first} WHEN {any_instr(t, from_words)} THEN '' ELSE {first} END)")
    return lo, hi


def salary_text_a_sql(raw: str):
    t = f"trim(regexp_replace(replace(lower({raw}), ',', '.'), '\\s+', ' ', 'g'))"
    mult = (f"(CASE WHEN {any_instr(t, MILLION_WORDS)} THEN 1000000.0 "
            f"WHEN {any_instr(t, THOUSAND_WORDS + ['k'])} THEN 1000.0 ELSE 1.0 END)")
    vals = (f"list_transform(regexp_extract_all({t}, '\\d+(?:\\.\\d+)?', 0), "
            f"lambda n: CAST(trunc(CAST(n AS DOUBLE) * {mult}) AS BIGINT))")
    return _pick(raw, t, vals, any_instr(t, NEGOTIABLE_WORDS_A), UP_TO_WORDS_A, FROM_WORDS_A)


def salary_text_b_sql(raw: str):
    t = f"trim(regexp_replace(replace(lower({raw}), chr(160), ' '), '\\s+', ' ', 'g'))"
    k = f"regexp_matches({t}, '(^|[^\\p{{L}}\\p{{N}}_])k($|[^\\p{{L}}\\p{{N}}_])')"
    mult = (f"(CASE WHEN {any_instr(t, MILLION_WORDS)} THEN 1000000 "
            f"WHEN {any_instr(t, THOUSAND_WORDS)} OR {k} THEN 1000 ELSE 1 END)")
    tok = ("(CASE WHEN regexp_matches(n, '[.,][0-9]{3}$') THEN TRY_CAST(regexp_replace(n, '[.,]', '', 'g') AS BIGINT) "
           "ELSE CAST(trunc(TRY_CAST(replace(n, ',', '.') AS DOUBLE)) AS BIGINT) END)")
    vals = (f"list_filter(list_transform(regexp_extract_all({t}, '\\d[\\d.,]*', 0), "
            f"lambda n: {tok} * {mult}), lambda v: v IS NOT NULL)")
    return _pick(raw, t, vals, any_instr(t, NEGOTIABLE_WORDS_B), UP_TO_WORDS_B, FROM_WORDS_B)


def skills_word_sql(expr: str, whitelist=None) -> str:
    """Whole-word matches: after normalisation the only non-word characters
    are ' ' and '-', so a bounded occurrence is a padded substring test."""
    pairs = pattern_pairs(whitelist)
    lex = "[" + ", ".join(f"{{'p': {q(p)}, 's': {q(s)}}}" for p, s in pairs) + "]"
    n = norm_sql(expr)
    t2 = f"(' ' || {n} || ' ')"
    cond = " OR ".join(f"instr({t2}, {a!r} || e.p || {b!r}) > 0" for a in (" ", "-") for b in (" ", "-"))
    found = f"list_transform(list_filter({lex}, lambda e: {cond}), lambda e: e.s)"
    for abbr, full in word_only_abbreviations(whitelist):
        found = (f"list_concat({found}, CASE WHEN list_contains(string_split({n}, ' '), {q(abbr)}) "
                 f"THEN [{q(full)}] ELSE []::VARCHAR[] END)")
    return (f"(CASE WHEN {expr} IS NULL OR {expr} = '' THEN []::VARCHAR[] "
            f"ELSE list_sort(list_distinct({found})) END)")
