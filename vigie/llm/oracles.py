"""DuckDB SQL with the results of the queries, where SQL can express them."""

from __future__ import annotations

from vigie.llm import licenses, quality

WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

#: Water filling by levels, as in the mix: sources in order of the level at which they stop.
MIX = f"""
WITH sized AS (SELECT doc_id, source, len({WORDS.format('text')})::BIGINT AS size FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
    (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END)::DOUBLE AS weight
  FROM by_source),
running AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS stopped, coalesce(sum(weight) OVER before, 0) AS stopped_weight,
    sum(weight) OVER () AS all_weight, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS budget
  FROM ranked WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (budget - stopped) / (all_weight - stopped_weight) AS height FROM running),
first_open AS (SELECT arg_min(height, cap / weight) AS height FROM levels WHERE height * weight < cap),
targets AS (SELECT source, source_size, least(cap, coalesce(first_open.height * weight, cap)) AS target FROM levels CROSS JOIN first_open),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS chance
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (chance < rate - floor(rate))::INT))::BIGINT AS taken FROM rated
"""


def _line_fails(line: str) -> str:
    words = WORDS.format(line)
    least = f"greatest(len({words}), 1)"
    furniture = " OR ".join(f"contains(lower({line}), '{p}')" for p in quality.BOILERPLATE)
    return (
        f"(len(regexp_extract_all({line}, '[#*$%&|<>]')) > {least} * 0.2"
        f" OR len(list_filter({words}, lambda w: regexp_matches(w, '[!?.,;:]{{2,}}$'))) > {least} * 0.5"
        f" OR ({least} >= 4 AND len(list_filter({words}, lambda w: regexp_full_match(w, '[|>»•·/]+'))) > {least} * 0.2)"
        f" OR len(list_filter(list_zip({words}[:-2], {words}[2:]), lambda p: p[1] = p[2])) > {least} * 0.5"
        f" OR ({least} <= 30 AND ({furniture})))"
    )


def kept_sql(documents: str = "documents") -> str:
    """Figures, verdict and cleaned text of every row of ``documents``."""
    has_word = r"regexp_matches({0}, '[^\x20\x09-\x0D]')"
    clean_characters = r"length(regexp_replace({0}, '[\x20\x09-\x0D]+', '', 'g'))"
    return f"""
    SELECT *, (NOT base_failed AND kept_share >= 0.7) AS kept FROM (
      SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
        CASE WHEN word_chars > 0 THEN {clean_characters.format("coalesce(clean_text, '')")}::DOUBLE / word_chars ELSE 0 END AS kept_share
      FROM (
        SELECT d.*, len(w)::BIGINT AS n_words, {clean_characters.format("coalesce(text, '')")}::BIGINT AS word_chars,
          len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
          (len(list_filter(l, lambda x: {has_word.format('x')})) - len(list_distinct(list_filter(l, lambda x: {has_word.format('x')}))))::BIGINT AS n_dup_lines,
          coalesce(repeated, 0)::BIGINT AS n_repeat_words,
          CASE WHEN text IS NOT NULL THEN array_to_string(list_filter(l, lambda x: NOT {has_word.format('x')} OR NOT {_line_fails('x')}), chr(10)) END AS clean_text
        FROM (SELECT *, row_number() OVER () AS r, {WORDS.format('text')} AS w, string_split(coalesce(text, ''), chr(10)) AS l FROM {documents}) d
        LEFT JOIN (
          SELECT r, sum(least(3, coalesce(following - place, 3))) AS repeated FROM (
            SELECT r, place, lead(place) OVER (PARTITION BY r ORDER BY place) AS following FROM (
              SELECT r, place, count(*) OVER (PARTITION BY r, g) AS n FROM (
                SELECT r, place, w[place] || ' ' || w[place + 1] || ' ' || w[place + 2] AS g
                FROM (SELECT row_number() OVER () AS r, {WORDS.format('text')} AS w FROM {documents}) x, unnest(range(1, len(w) - 1)) u(place))
            ) WHERE n > 1)
          GROUP BY r) USING (r)))
    """


QUALITY = f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept_share, kept FROM ({kept_sql()})"


def _licenses() -> str:
    parts = []
    for place, (name, text) in enumerate(licenses.TEMPLATES):
        own = ", ".join(f"'{g}'" for g in licenses.bigrams_of(text))
        n = len(licenses.bigrams_of(text))
        low, high = n * licenses.ALIKE / (2 - licenses.ALIKE), n * (2 - licenses.ALIKE) / licenses.ALIKE
        parts.append(
            f"SELECT r, {place} AS place, '{name}' AS license, 2.0::DOUBLE * len(list_intersect(g, [{own}])) / (len(g) + {n}) AS dice"
            f" FROM grams WHERE len(g) BETWEEN {low!r} AND {high!r}")
    return f"""
    WITH parts AS (
      SELECT doc_id, unnest(CASE WHEN len(l) > 1 THEN list_append(l, t) ELSE l END) AS part
      FROM (SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    worded AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(part), '[^0-9a-z]+'), lambda w: w <> '') AS w FROM parts),
    grams AS MATERIALIZED (SELECT r, doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM worded),
    scores AS ({' UNION ALL '.join(parts)}),
    best AS (SELECT r, arg_min(license, place) AS license, any_value(dice) AS dice FROM scores s
      WHERE dice >= {licenses.ALIKE} AND dice = (SELECT max(dice) FROM scores x WHERE x.r = s.r) GROUP BY r)
    SELECT doc_id, license, count(*) AS notices, max(dice) AS dice FROM best JOIN grams USING (r) GROUP BY doc_id, license
    """


PREFERENCE = """
WITH spoken AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
answers AS (
  SELECT conv_id, max({'turn': turn, 'role': role, 'text': text}) AS own FROM spoken WHERE lower(role) = 'assistant' GROUP BY conv_id),
ends AS (
  SELECT a.conv_id, a.own.turn AS ends_at, b.own.role AS role, b.own.text AS text FROM answers a JOIN answers b ON b.conv_id = a.conv_id + 1),
said AS (
  SELECT conv_id AS pair_id, true AS chosen, turn, s.role, s.text FROM spoken s JOIN ends e USING (conv_id) WHERE turn <= ends_at
  UNION SELECT conv_id, false, turn, s.role, s.text FROM spoken s JOIN ends e USING (conv_id) WHERE turn < ends_at
  UNION SELECT conv_id, false, ends_at, role, text FROM ends),
turns AS (SELECT pair_id, turn, role, text, bool_or(chosen) AS in_chosen, bool_or(NOT chosen) AS in_rejected FROM said GROUP BY ALL),
pairs AS (
  SELECT pair_id, min(turn) FILTER (in_chosen <> in_rejected) AS differs_at, max(turn) FILTER (in_chosen) AS chosen_to,
    max(turn) FILTER (in_rejected) AS rejected_to
  FROM turns GROUP BY pair_id HAVING bool_or(in_chosen) AND bool_or(in_rejected)),
parts AS (
  SELECT pair_id, unnest(CASE WHEN differs_at IS NULL OR turn < differs_at THEN ['prompt']
    ELSE list_filter([CASE WHEN in_chosen THEN 'chosen' END, CASE WHEN in_rejected THEN 'rejected' END], lambda s: s IS NOT NULL) END) AS part,
    turn, role, text
  FROM turns JOIN pairs USING (pair_id)),
shown AS (
  SELECT pair_id, part, turn, role,
    '<|turn|>' || role || chr(10) || replace(replace(text, '<|turn|>', '<| turn|>'), '<|end|>', '<| end|>') || '<|end|>' || chr(10) AS rendered,
    lower(role) = 'assistant' AND part <> 'prompt' AS learned
  FROM parts)
SELECT *, CASE WHEN learned THEN length('<|turn|>' || role) + 1 ELSE 0 END::BIGINT AS learn_from,
  CASE WHEN learned THEN length(rendered) - 1 ELSE 0 END::BIGINT AS learn_to
FROM shown
UNION ALL SELECT pair_id, 'chosen', NULL, NULL, '', false, 0, 0 FROM pairs WHERE coalesce(chosen_to < differs_at, true)
UNION ALL SELECT pair_id, 'rejected', NULL, NULL, '', false, 0, 0 FROM pairs WHERE coalesce(rejected_to < differs_at, true)
"""

#: Every window of every positive searched by itself.
HARD_NEGATIVES = """
WITH vectors AS (
  SELECT vec_id::BIGINT AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS codes
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same, list_inner_product(a.codes, b.codes)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.id <> b.id WHERE a.id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER best)::INT AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER best <= 3
"""

ORACLES = {
    "op1_mix": MIX, "op3_licenses": _licenses(), "op7_quality_rules": QUALITY, "op8_preference": PREFERENCE,
    "op12_hard_negatives": HARD_NEGATIVES,
}
