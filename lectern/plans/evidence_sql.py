"""DuckDB SQL for the queries of evidence.py, written independently of the operators."""

from __future__ import annotations

from .fixtures import ANCHORS_SQL, SOURCE_LINES_SQL, WORDS_SQL

_EDGES = ".,;:!?()[]{}\"''"
_TOKEN = f"lower(trim(text, '{_EDGES}'))"
_LIKE = f"regexp_matches({_TOKEN}, '^[A-Za-z][A-Za-z''-]{{2,}}$')"


def _summary(value: str) -> str:
    return f"count({value}) AS n_words, avg({value}) AS mean_confidence, count(*) FILTER ({value} < 50) AS below_50, count(*) FILTER ({value} < 70) AS below_70, count(*) FILTER ({value} < 85) AS below_85"


_SEMANTIC = f"CASE WHEN {_LIKE} THEN confidence END"
_SPACED = "trim(regexp_replace(translate(coalesce(text, ''), '–—', '--'), '[\\s\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g'))"


def _spaced(x: str) -> str:
    return _SPACED.replace("text", x, 1)


def _letters(x: str) -> str:
    return f"regexp_replace({x}, '[^\\p{{L}}]', '', 'g')"


def _ratio(x: str) -> str:
    return f"length(regexp_replace({x}, '[^\\p{{Lu}}]', '', 'g')) / greatest(1, length({_letters(x)}))"


_STOP = "('CONTENTS', 'INTRODUCTION', 'DESCRIPTION AND OPERATION', 'ADJUSTMENTS', 'REPAIRS')"


def _is_title(x: str) -> str:
    return f"(length({_letters(x)}) >= 4 AND length({x}) <= 110 AND {_ratio(x)} >= 0.82 AND upper({x}) NOT IN {_STOP})"


def _clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({_spaced(x)}, '^[^A-Za-z0-9]+', ''), '[^A-Za-z0-9)./&+-]+$', ''), ' .:-|')"


def _is_heading(x: str) -> str:
    return f"(length({_letters(x)}) >= 4 AND length({x}) <= 110 AND {_ratio(x)} >= 0.72 AND upper({x}) <> 'CONTENTS')"


_LEXICON = f"""
forms AS (SELECT source, {_TOKEN} AS token, text, count(*) AS n, sum(confidence) AS total, min((page, block_num, par_num, line_num, word_num)) AS first
  FROM words WHERE confidence >= 92 AND {_LIKE} GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, token ORDER BY n DESC, first) AS place FROM forms),
lex AS (SELECT source, token, max(CASE WHEN place = 1 THEN text END) AS canonical, CAST(sum(n) AS BIGINT) AS occurrences, sum(total) / sum(n) AS mean_confidence
  FROM ranked GROUP BY 1, 2 HAVING sum(n) >= 2)"""

_REGIONS = "placed0 AS (SELECT *, CASE WHEN top < page_height * 0.055 THEN 'header' WHEN top >= page_height * 0.94 THEN 'footer' ELSE 'body' END AS region FROM words)"
_GUTTERS = """
xs AS (SELECT unnest(range(CAST(trunc(2480 * 0.32) AS BIGINT), CAST(trunc(2480 * 0.68) AS BIGINT) + 1, 10)) AS x),
cand0 AS (SELECT source, page, x, count(*) AS body_words, count(*) FILTER ("left" < x AND x < "left" + width) AS crossing_words,
  count(*) FILTER ("left" + width <= x) AS left_words, count(*) FILTER ("left" >= x) AS right_words,
  min("left") FILTER ("left" >= x) - max("left" + width) FILTER ("left" + width <= x) AS gap_px
  FROM placed0, xs WHERE region = 'body' GROUP BY 1, 2, 3),
cand AS (SELECT source, page, x, crossing_words, left_words, right_words, gap_px, least(left_words, right_words) / greatest(left_words, right_words) AS balance
  FROM cand0 WHERE body_words >= 20 AND left_words >= 10 AND right_words >= 10),
scored AS (SELECT *, CAST(crossing_words * 1000 - greatest(0, gap_px) * 2 - balance * 20 AS DOUBLE) AS score FROM cand),
best AS (SELECT * EXCLUDE (place), crossing_words <= 1 AND ((balance >= 0.35 AND gap_px >= 35) OR (balance >= 0.18 AND gap_px >= 120)) AS two_columns
  FROM (SELECT *, row_number() OVER (PARTITION BY source, page ORDER BY score, x) AS place FROM scored) WHERE place = 1),
placed AS (SELECT p.* EXCLUDE (region), CASE WHEN p.region = 'body' AND g.x IS NOT NULL THEN CASE WHEN "left" + width <= g.x THEN 'left' WHEN "left" >= g.x THEN 'right' ELSE 'spanning' END ELSE p.region END AS region
  FROM placed0 p LEFT JOIN (SELECT source, page, x FROM best WHERE two_columns) g USING (source, page))"""


def _lines(source: str, name: str) -> str:
    return f"""
{name}0 AS (SELECT source, page, region, block_num, par_num, line_num, string_agg(text, ' ' ORDER BY "left", word_num, text) AS text, min("left") AS x0, min(top) AS y0,
  max("left" + width) AS x1, max(top + height) AS y1, count(*) AS word_count, avg(confidence) AS mean_confidence FROM {source} GROUP BY 1, 2, 3, 4, 5, 6),
{name} AS (SELECT *, row_number() OVER (PARTITION BY source, page, region ORDER BY y0, x0, block_num, par_num, line_num) - 1 AS line_index FROM {name}0)"""


_PHASE = "regexp_matches(p, '^(remove|refit|refitting|dismantle|reassemble|adjust|adjustment|check|inspection|overhaul)$')"
_STRUCTURE = f"""{SOURCE_LINES_SQL},
norm AS (SELECT page, region, line_index, mean_confidence, {_SPACED} AS text FROM source_lines WHERE region NOT IN ('header', 'footer', 'spanning')),
marked AS MATERIALIZED (SELECT *, nullif(regexp_extract(text, '(?i)\\bService\\s+Repair\\s+No\\.?\\s*([0-9]+(?:\\.[0-9]+){{1,4}})\\b', 1), '') AS repair, {_is_title('text')} AS titled,
  lower(trim(text, ' .:-')) AS p, TRY_CAST(regexp_extract(text, '^\\s*(\\d{{1,3}})\\.\\s*(.*)$', 1) AS INTEGER) AS number FROM norm),
anchors AS (SELECT a.page, a.region, a.line_index AS anchor, a.repair, max(b.line_index) AS title_at FROM marked a
  LEFT JOIN marked b ON b.page = a.page AND b.region = a.region AND b.line_index BETWEEN a.line_index - 4 AND a.line_index - 1 AND b.titled WHERE a.repair IS NOT NULL GROUP BY 1, 2, 3, 4),
spans AS (SELECT *, lead(anchor) OVER w AS next_anchor, lead(title_at) OVER w AS next_title FROM anchors WINDOW w AS (PARTITION BY page, region ORDER BY anchor)),
segs AS (SELECT page, region, anchor, repair, title_at, CASE WHEN next_anchor IS NULL THEN 1000000000 WHEN next_title > anchor THEN next_title ELSE next_anchor END AS stop FROM spans),
inside AS (SELECT m.*, s.anchor, s.title_at, s.repair AS own_repair, CASE WHEN {_PHASE} THEN p END AS phase_source
  FROM segs s JOIN marked m ON m.page = s.page AND m.region = s.region AND m.line_index > s.anchor AND m.line_index < s.stop WHERE m.text <> ''),
ph AS (SELECT *, count(phase_source) OVER (PARTITION BY page, region, anchor ORDER BY line_index) AS phase_no,
  last_value(phase_source IGNORE NULLS) OVER (PARTITION BY page, region, anchor ORDER BY line_index ROWS UNBOUNDED PRECEDING) AS source_form,
  phase_source IS NULL AND number IS NOT NULL AS is_step FROM inside),
st AS (SELECT *, count(*) FILTER (is_step) OVER (PARTITION BY page, region, anchor, phase_no ORDER BY line_index) AS step_no,
  CASE WHEN source_form = 'refitting' THEN 'refit' ELSE source_form END AS phase FROM ph),
kinds AS MATERIALIZED (SELECT *, CASE WHEN phase_source IS NOT NULL THEN 'phase' WHEN is_step THEN 'step'
  WHEN step_no > 0 AND regexp_matches(text, '(?i)^\\s*(?:[•●▪◦*-]|[eo]\\s+)\\s*(.*)$') THEN 'bullet' WHEN step_no > 0 THEN 'continuation' ELSE 'other' END AS kind FROM st),
breaks AS (SELECT *, number <> lag(number) OVER (PARTITION BY page, region, anchor, phase_no ORDER BY line_index) + 1 AS broken FROM kinds WHERE kind = 'step'),
by_phase AS (SELECT page, region, anchor, phase_no, count(*) AS n, count(*) FILTER (broken) AS b FROM breaks GROUP BY 1, 2, 3, 4),
bad AS (SELECT page, region, anchor, bool_or(phase_no > 0 AND n > 1 AND b > 0) AS bad_phase FROM by_phase GROUP BY 1, 2, 3),
procs0 AS (SELECT page, region, anchor, any_value(own_repair) AS repair_number, any_value(title_at) AS title_at, count(*) FILTER (kind = 'step') AS n_steps, count(*) FILTER (kind = 'phase') AS n_phases,
  count(*) FILTER (kind = 'step' AND phase_no = 0) AS unphased, count(*) FILTER (kind IN ('step', 'continuation') AND mean_confidence < 70) AS low,
  string_agg(CASE WHEN kind = 'step' THEN number END, ',' ORDER BY line_index) AS step_numbers, max_by(number, line_index) FILTER (kind = 'step') AS last_step, count(*) FILTER (kind = 'other') AS n_uncategorised
  FROM kinds GROUP BY 1, 2, 3),
procs AS (SELECT p.*, b.bad_phase, m.text AS title FROM procs0 p LEFT JOIN bad b USING (page, region, anchor) LEFT JOIN marked m ON m.page = p.page AND m.region = p.region AND m.line_index = p.title_at
  WHERE n_steps >= 2 AND n_phases > 0)"""

_CLASSES = f"""
sums AS (SELECT page, count(*) AS n_lines, count(*) FILTER (region NOT IN ('header', 'footer', 'spanning') AND regexp_matches({_SPACED}, '^\\s*(\\d{{1,3}})\\.\\s*(.*)$')) AS n_numbered,
  bool_or(upper(trim({_SPACED}, ' .:-')) = 'CONTENTS') AS c, bool_or(upper(trim({_SPACED}, ' .:-')) = 'INTRODUCTION') AS i FROM source_lines GROUP BY page),
np AS (SELECT page, count(*) AS n_procedures FROM procs GROUP BY page),
classes AS (SELECT page, n_lines, n_numbered, coalesce(n_procedures, 0) AS n_procedures, CASE WHEN n_procedures > 0 THEN 'repair_procedure_page' WHEN c AND n_lines >= 8 THEN 'contents_page_candidate'
  WHEN n_numbered >= 5 THEN 'numbered_component_or_reference_list_candidate' WHEN i THEN 'front_matter_or_narrative_candidate' ELSE 'unclassified_candidate' END AS page_class FROM sums LEFT JOIN np USING (page))"""

_STATUS = "CASE WHEN {n} = 0 THEN 'none' WHEN {n} = 1 THEN 'single_step' WHEN {b} = 0 THEN 'contiguous' ELSE 'gap_restart_or_ocr_error' END"

_CHAPTERS = f"""{ANCHORS_SQL},
known AS (SELECT *, CASE WHEN title IS NOT NULL AND title <> '' THEN lower({_spaced('title')}) END AS k FROM anchors),
marks AS (SELECT *, CASE WHEN k IS NULL OR lag(k) OVER (ORDER BY page) IS NULL OR k <> lag(k) OVER (ORDER BY page) THEN 1 ELSE 0 END AS new FROM known),
nos AS (SELECT *, sum(new) OVER (ORDER BY page) AS no FROM marks),
chap0 AS (SELECT no, min(page) AS start_page, min_by(title, page) AS title, count(*) AS n_anchors, bool_or(status = 'REVIEW_REQUIRED') AS review FROM nos GROUP BY no),
chap AS (SELECT 'chapter-' || lpad(CAST(start_page AS VARCHAR), 4, '0') || '-' || coalesce(nullif(trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unresolved') AS chapter_id, title, start_page,
  coalesce(lead(start_page) OVER (ORDER BY start_page) - 1, (SELECT max(page_id) FROM pages)) AS end_page, n_anchors, CASE WHEN review THEN 'REVIEW_REQUIRED' ELSE 'CANDIDATE_ONLY' END AS status FROM chap0)"""

_RAW = f"""{_STRUCTURE},
frag0 AS (SELECT page, region, list(number ORDER BY line_index) FILTER (number IS NOT NULL) AS numbers, count(*) FILTER ({_PHASE}) AS n_phases, bool_or(repair IS NOT NULL) AS anchored FROM marked GROUP BY 1, 2),
frag AS (SELECT page, region, array_to_string(numbers, ',') AS step_numbers, numbers[1] AS first_step, numbers[-1] AS last_step, n_phases FROM frag0
  WHERE NOT anchored AND len(numbers) >= 2 AND (n_phases > 0 OR numbers[1] > 1))"""

_FRAGMENTS = f"""{_RAW},
context AS (SELECT DISTINCT page, CASE WHEN page % 29 <> 0 THEN 'chapter-' || (page // 40) END AS chapter_id FROM source_lines),
placed AS (SELECT f.*, c.chapter_id, coalesce(f.page > 1 AND c.chapter_id = b.chapter_id, false) AS same_chapter,
  EXISTS (SELECT 1 FROM procs q WHERE q.page + 1 = f.page AND q.last_step + 1 = f.first_step) AS after_procedure
  FROM frag f LEFT JOIN context c ON c.page = f.page LEFT JOIN context b ON b.page = f.page - 1),
ok(page, region, last_step) AS (
  SELECT page, region, last_step FROM placed WHERE n_phases > 0 OR (same_chapter AND after_procedure)
  UNION SELECT p.page, p.region, p.last_step FROM placed p JOIN ok ON p.page = ok.page + 1 AND p.first_step = ok.last_step + 1 WHERE p.same_chapter),
judged AS (SELECT p.*, ok.page IS NOT NULL AS accepted FROM placed p LEFT JOIN ok ON ok.page = p.page AND ok.region = p.region),
proven AS (SELECT *, CASE WHEN accepted THEN concat_ws(',', CASE WHEN n_phases > 0 THEN 'manufacturer_phase_heading' END, CASE WHEN same_chapter THEN 'same_manufacturer_chapter' END,
  CASE WHEN n_phases = 0 AND after_procedure THEN 'continues_previous_page_procedure_numbering' WHEN n_phases = 0 THEN 'continues_previous_page_fragment_numbering' END) END AS evidence FROM judged)"""

_CONTENTS = f"""
pagelines AS (SELECT DISTINCT l_orderkey AS page, CASE WHEN l_partkey % 13 = 0 THEN 'header' ELSE 'body' END AS region, l_linenumber * 1000000 + l_partkey AS seq,
  CASE WHEN l_partkey % 11 = 0 THEN '#### ... ' || coalesce(p_name, 'part') WHEN l_linenumber = 1 THEN 'Contents:' WHEN l_linenumber = 3 THEN 'REPAIRS' WHEN l_linenumber = 5 THEN 'General  information.'
  ELSE '  ' || coalesce(p_name, 'part') || ' . . . ' || (l_partkey % 400) || ' ' END AS text FROM lineitem LEFT JOIN part ON p_partkey = l_partkey),
norm AS (SELECT page, region, seq, {_SPACED} AS raw_text FROM pagelines),
starts AS (SELECT page, min(seq) AS start FROM norm WHERE upper(trim(raw_text, ' .:-')) = 'CONTENTS' GROUP BY page),
after AS (SELECT n.*, upper(trim(raw_text, ' .:-')) IN ('DESCRIPTION', 'DESCRIPTION AND OPERATION', 'ADJUSTMENT', 'ADJUSTMENTS', 'REPAIR', 'REPAIRS', 'GENERAL INFORMATION', 'WIRE HARNESS AND EARTH LOCATIONS') AS is_group
  FROM norm n JOIN starts s ON s.page = n.page AND n.seq > s.start WHERE region NOT IN ('header', 'footer') AND raw_text <> ''),
entries AS (SELECT *, last_value(CASE WHEN is_group THEN trim(raw_text, ' .:-') END IGNORE NULLS) OVER (PARTITION BY page ORDER BY seq ROWS UNBOUNDED PRECEDING) AS "group",
  CASE WHEN NOT is_group THEN TRY_CAST(regexp_extract(raw_text, '\\s+(\\d{{1,3}})\\s*$', 1) AS INTEGER) END AS printed_page FROM after),
titled AS (SELECT *, CASE WHEN is_group THEN NULL WHEN printed_page IS NOT NULL THEN rtrim(regexp_replace(raw_text, '\\s+(\\d{{1,3}})\\s*$', ''), ' .:-') ELSE raw_text END AS title_candidate FROM entries),
noisy AS (SELECT *, 1.0 - length({_letters('title_candidate')}) / greatest(1, length(regexp_replace(title_candidate, '\\s', '', 'g'))) AS noise_ratio FROM titled)"""

ORACLE_SQL = {
    "page_confidence_summary": f"WITH {WORDS_SQL} SELECT source, page, {_summary('confidence')} FROM words GROUP BY 1, 2",
    "semantic_confidence_summary": f"""WITH {WORDS_SQL}, s AS (SELECT source, page, {_summary(_SEMANTIC)} FROM words GROUP BY 1, 2)
SELECT *, below_50 / nullif(n_words, 0) AS below_50_ratio, below_85 / nullif(n_words, 0) AS below_85_ratio FROM s""",
    "page_review_first_pass": f"""WITH {WORDS_SQL}, s AS (SELECT source, page, {_summary('confidence')}, max(length(text)) AS longest FROM words GROUP BY 1, 2)
SELECT source, page, n_words, mean_confidence, longest, concat_ws(',', CASE WHEN mean_confidence < 85 THEN 'mean_ocr_confidence_below_85' END, CASE WHEN below_50 > 0 THEN 'contains_ocr_word_below_50' END,
  CASE WHEN longest > 120 THEN 'suspiciously_long_ocr_token' END) AS reasons FROM s""",
    "page_review_refined": f"""WITH {WORDS_SQL}, s AS (SELECT source, page, {_summary(_SEMANTIC)}, max(length(text)) AS longest FROM words GROUP BY 1, 2)
SELECT source, page, n_words, mean_confidence, below_50, concat_ws(',', CASE WHEN n_words = 0 THEN 'no_semantic_ocr_words' END, CASE WHEN mean_confidence < 85 THEN 'semantic_mean_ocr_confidence_below_85' END,
  CASE WHEN n_words > 0 AND below_50 >= greatest(3, ceil(n_words * 0.05)) THEN 'dense_semantic_ocr_words_below_50' END, CASE WHEN longest > 120 THEN 'suspiciously_long_ocr_token' END) AS reasons FROM s""",
    "translation_gate": f"""WITH {WORDS_SQL}, s AS (SELECT source, page, count(*) FILTER ({_LIKE} AND confidence < 85) AS doubtful_words FROM words GROUP BY 1, 2)
SELECT *, CASE WHEN doubtful_words > 0 THEN 'BLOCKED_OCR_REVIEW' ELSE 'SOURCE_TEXT_READY' END AS gate FROM s""",
    "document_lexicon": f"WITH {WORDS_SQL}, {_LEXICON} SELECT source, token, canonical, occurrences, mean_confidence FROM lex",
    "lexicon_spelling_candidates": f"""WITH {WORDS_SQL}, {_LEXICON},
suspects AS (SELECT source, page, line_num, word_num, text AS original, confidence, {_TOKEN} AS token, "left", top, width, height FROM words WHERE confidence < 85 AND {_LIKE} AND length({_TOKEN}) >= 4),
tokens AS (SELECT DISTINCT source, token, CASE WHEN length(token) <= 7 THEN 1 ELSE 2 END AS d FROM suspects s WHERE NOT EXISTS (SELECT 1 FROM lex WHERE lex.source = s.source AND lex.token = s.token)),
near AS (SELECT t.source, t.token, l.token AS known, l.canonical, l.occurrences, l.mean_confidence, levenshtein(t.token, l.token) AS distance
  FROM tokens t JOIN lex l ON l.source = t.source AND l.token[1] = t.token[1] AND abs(length(l.token) - length(t.token)) <= d AND levenshtein(t.token, l.token) <= d),
best AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY source, token ORDER BY distance, occurrences DESC, mean_confidence DESC) AS place FROM near) WHERE place = 1),
tied AS (SELECT *, row_number() OVER (PARTITION BY source, token ORDER BY known) AS k, count(*) OVER (PARTITION BY source, token) AS ties FROM best),
shown AS (SELECT source, token, any_value(ties) AS ties, string_agg(known || ':' || canonical || ':' || distance || ':' || occurrences, '|' ORDER BY known) FILTER (k <= 5) AS proposals FROM tied GROUP BY 1, 2)
SELECT s.source, page, line_num, word_num, original, confidence, s.token, CASE WHEN ties = 1 THEN 'STRONG_CANDIDATE_REVIEW_REQUIRED' ELSE 'REVIEW_REQUIRED' END AS status, ties, proposals,
  concat_ws(',', "left", top, "left" + width, top + height) AS bbox FROM suspects s JOIN shown b ON b.source = s.source AND b.token = s.token""",
    "ocr_lines": f"WITH {WORDS_SQL}, {_REGIONS}, {_lines('placed0', 'ln')} SELECT source, page, region, line_num, line_index, text, x0, y0, x1, y1, word_count, mean_confidence FROM ln",
    "page_text": f"""WITH {WORDS_SQL}, l AS (SELECT source, page, block_num, par_num, line_num, string_agg(text, ' ' ORDER BY word_num) AS said FROM words GROUP BY 1, 2, 3, 4, 5),
g AS (SELECT *, CASE WHEN lag(block_num) OVER w <> block_num OR lag(par_num) OVER w <> par_num THEN chr(10) || said ELSE said END AS t FROM l WINDOW w AS (PARTITION BY source, page ORDER BY block_num, par_num, line_num))
SELECT source, page, string_agg(t, chr(10) ORDER BY block_num, par_num, line_num) AS page_text FROM g GROUP BY 1, 2""",
    "region_word_counts": f"WITH {WORDS_SQL}, {_REGIONS}, {_GUTTERS} SELECT source, page, region, count(*) AS n_words FROM placed GROUP BY 1, 2, 3",
    "gutter_candidates": f"WITH {WORDS_SQL}, {_REGIONS}, {_GUTTERS} SELECT source, page, CAST(x AS INTEGER) AS x, crossing_words, left_words, right_words, gap_px, balance, score FROM scored",
    "best_gutters": f"WITH {WORDS_SQL}, {_REGIONS}, {_GUTTERS} SELECT source, page, CAST(x AS INTEGER) AS x, crossing_words, left_words, right_words, gap_px, balance, score, two_columns FROM best",
    "page_layout": f"""WITH {WORDS_SQL}, {_REGIONS}, {_GUTTERS}, {_lines('placed', 'ln')},
r AS (SELECT *, CASE region WHEN 'header' THEN 0 WHEN 'left' THEN 1 WHEN 'body' THEN 1 WHEN 'right' THEN 2 WHEN 'spanning' THEN 3 ELSE 4 END AS rank FROM ln)
SELECT source, page, coalesce(string_agg(text, chr(10) ORDER BY rank, line_index) FILTER (trim(text) <> ''), '') AS candidate_text, count(*) AS n_lines,
  {', '.join(f"CAST(coalesce(sum(word_count) FILTER (region = '{x}'), 0) AS BIGINT) AS {x}_words" for x in ('header', 'left', 'body', 'right', 'spanning', 'footer'))},
  CASE WHEN coalesce(any_value(two_columns), false) THEN 'possible_two_columns' ELSE 'single_flow_or_noncolumn' END AS layout_type, CASE WHEN coalesce(any_value(two_columns), false) THEN 'REVIEW_REQUIRED' ELSE 'CANDIDATE_ONLY' END AS status
FROM r LEFT JOIN (SELECT source, page, two_columns FROM best) USING (source, page) GROUP BY 1, 2""",
    "native_column_signal": f"""WITH {WORDS_SQL}, {_REGIONS}, {_lines('placed0', 'ln')},
u AS (SELECT *, length(trim(text)) >= 4 AS usable, greatest(0.0, (x1 - x0) / 2480) >= 0.72 AS wide, (x0 + x1) / 2 AS center FROM ln),
f AS (SELECT *, usable AND NOT wide AND center < 2480 * 0.46 AS l, usable AND NOT wide AND center > 2480 * 0.54 AS r FROM u),
s AS (SELECT source, page, count(*) FILTER (l) AS left_lines, count(*) FILTER (r) AS right_lines, count(*) FILTER (usable AND wide) AS full_width_lines,
  min(y0) FILTER (l) AS a, max(y1) FILTER (l) AS b, min(y0) FILTER (r) AS c, max(y1) FILTER (r) AS d FROM f GROUP BY 1, 2)
SELECT source, page, left_lines, right_lines, full_width_lines, left_lines >= 3 AND right_lines >= 3 AS possible_multicolumn,
  CASE WHEN left_lines >= 3 AND right_lines >= 3 THEN greatest(0, least(b, d) - greatest(a, c)) / greatest(1, least(b - a, d - c)) ELSE 0.0 END AS vertical_overlap_ratio,
  CASE WHEN left_lines >= 3 AND right_lines >= 3 THEN 'review_required' ELSE 'native_geometry_preserved' END AS status FROM s""",
    "phase_sequence_status": f"""WITH s AS (SELECT l_orderkey AS procedure, CASE l_returnflag WHEN 'R' THEN 'remove' WHEN 'A' THEN 'adjust' ELSE 'refit' END AS phase, l_linenumber AS number,
  lag(l_linenumber) OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS before FROM lineitem),
g AS (SELECT procedure, phase, count(*) AS n_steps, count(*) FILTER (number <> before + 1) AS breaks FROM s GROUP BY 1, 2)
SELECT *, {_STATUS.format(n='n_steps', b='breaks')} AS status FROM g""",
    "procedures": f"""WITH {_STRUCTURE} SELECT page, region, anchor, repair_number, title, n_steps, n_phases, step_numbers, n_uncategorised,
  CASE WHEN bad_phase THEN 'phase_sequence_issue' WHEN unphased > 0 THEN 'unphased_steps_present' ELSE 'contiguous_by_phase' END AS sequence_status,
  concat_ws(',', CASE WHEN title IS NULL THEN 'missing_title' END, CASE WHEN unphased > 0 THEN 'step_without_phase' END, CASE WHEN bad_phase THEN 'phase_step_sequence_not_contiguous' END, CASE WHEN low > 0 THEN 'low_ocr_confidence_in_step' END) AS review_reasons FROM procs""",
    "procedure_steps": f"""WITH {_STRUCTURE} SELECT page, region, anchor, phase_no, step_no, max(phase) AS phase, max(number) FILTER (kind = 'step') AS number,
  trim(string_agg(CASE kind WHEN 'step' THEN trim(regexp_extract(text, '^\\s*(\\d{{1,3}})\\.\\s*(.*)$', 2)) WHEN 'continuation' THEN text END, ' ' ORDER BY line_index)) AS text,
  coalesce(string_agg(CASE WHEN kind = 'bullet' THEN trim(regexp_extract(text, '(?i)^\\s*(?:[•●▪◦*-]|[eo]\\s+)\\s*(.*)$', 1)) END, '|' ORDER BY line_index), '') AS subitems,
  count(*) FILTER (kind = 'bullet') AS n_subitems, min(mean_confidence) FILTER (kind <> 'bullet') AS least_confidence FROM kinds WHERE kind IN ('step', 'bullet', 'continuation') GROUP BY 1, 2, 3, 4, 5""",
    "procedure_phases": f"""WITH {_STRUCTURE}, h AS (SELECT page, region, anchor, phase_no, phase, phase_source FROM kinds WHERE kind = 'phase')
SELECT page, region, anchor, phase_no, phase, phase_source, coalesce(n, 0) AS n_steps, {_STATUS.format(n='coalesce(n, 0)', b='b')} AS status FROM h LEFT JOIN by_phase USING (page, region, anchor, phase_no)""",
    "numbered_lines": f"WITH {_STRUCTURE} SELECT page, region, line_index, number, trim(regexp_extract(text, '^\\s*(\\d{{1,3}})\\.\\s*(.*)$', 2)) AS body FROM marked WHERE number IS NOT NULL",
    "page_class": f"WITH {_STRUCTURE}, {_CLASSES} SELECT * FROM classes",
    "page_class_histogram": f"WITH {_STRUCTURE}, {_CLASSES} SELECT page_class, count(*) AS n_pages FROM classes GROUP BY 1",
    "title_candidates": f"""WITH l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line0, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_num FROM documents),
l AS (SELECT doc_id, line_num, CASE WHEN (doc_id + line_num) % 3 = 0 THEN translate(line0, 'abcdefghijklmnopqrstuvwxyzäöüéèñ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÑ') ELSE line0 END AS line FROM l0),
n AS (SELECT doc_id, line_num, {_spaced('line')} AS title, {_clean('line')} AS heading FROM l),
f AS (SELECT *, {_is_title('title')} AS is_title, {_is_heading('heading')} AS is_heading FROM n) SELECT * FROM f WHERE is_title OR is_heading""",
    "heading_ratio": f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_num FROM documents),
n AS (SELECT doc_id, line_num, {_spaced('line')} AS s FROM l)
SELECT doc_id, line_num, length({_letters('s')}) AS n_letters, {_ratio('s')} AS upper_share, 1.0 - length({_letters('s')}) / greatest(1, length(regexp_replace(s, '\\s', '', 'g'))) AS noise FROM n""",
    "contents_entries": f"""WITH {_CONTENTS} SELECT page, seq, CASE WHEN is_group THEN 'group_heading_candidate' ELSE 'contents_entry_candidate' END AS role,
  CASE WHEN noise_ratio > 0.45 THEN 'REVIEW_REQUIRED' ELSE 'CANDIDATE_ONLY' END AS status, "group", raw_text, title_candidate, printed_page, noise_ratio FROM noisy""",
    "chapter_ranges": f"WITH {_CHAPTERS} SELECT * FROM chap",
    "page_chapter_context": f"""WITH {_CHAPTERS} SELECT page_id AS page, chapter_id, title AS chapter_title,
  CASE WHEN chapter_id IS NULL THEN 'before_first_resolved_chapter_anchor' ELSE 'physical_range_from_manufacturer_contents_anchor' END AS reason FROM pages LEFT JOIN chap ON page_id BETWEEN start_page AND end_page""",
    "anchor_titles": f"""WITH h AS (SELECT page_id AS p, n_name AS text FROM pages JOIN nation ON n_nationkey = page_id % 25 WHERE page_id % 3 = 0),
t AS (SELECT p, {_clean('text')} AS title FROM h), u AS (SELECT * FROM t WHERE {_is_heading('title')}),
b AS (SELECT a.page_id AS page, min((p, title)) AS b FROM pages a LEFT JOIN u ON p BETWEEN a.page_id AND a.page_id + 4 WHERE a.page_id % 5 = 0 GROUP BY 1),
c AS (SELECT a.page, min(p) AS p FROM b a LEFT JOIN u ON p BETWEEN a.page AND a.page + 4 GROUP BY 1)
SELECT c.page, u.title, CASE WHEN c.p IS NULL THEN 'unresolved' WHEN c.p = c.page THEN 'contents_page_header' ELSE 'nearby_following_page_header' END AS method,
  CASE WHEN c.p = c.page THEN 'CANDIDATE_ONLY' ELSE 'REVIEW_REQUIRED' END AS status FROM c LEFT JOIN u ON u.p = c.p""",
    "fragments_raw": f"WITH {_RAW} SELECT page, region, first_step, last_step, n_phases, step_numbers FROM frag",
    "fragments_accepted": f"""WITH RECURSIVE {_FRAGMENTS} SELECT page, region, first_step, last_step, chapter_id, same_chapter, accepted, evidence,
  CASE WHEN accepted THEN NULL WHEN NOT same_chapter THEN 'numbering_only_without_same_resolved_chapter' ELSE 'numbering_only_without_adjacent_procedure_progression' END AS rejection FROM proven""",
    "fragment_links": f"""WITH RECURSIVE {_FRAGMENTS} SELECT page - 1 AS from_page, page AS to_page, region AS to_region, chapter_id, step_numbers,
  concat_ws(',', 'adjacent_physical_page', 'same_manufacturer_chapter', nullif(concat_ws(',', CASE WHEN n_phases > 0 THEN 'manufacturer_phase_heading' END,
  CASE WHEN n_phases = 0 AND after_procedure THEN 'continues_previous_page_procedure_numbering' WHEN n_phases = 0 THEN 'continues_previous_page_fragment_numbering' END), '')) AS evidence
  FROM proven WHERE accepted AND page > 1 AND same_chapter""",
}
