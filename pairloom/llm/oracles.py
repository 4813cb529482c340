"""SQL that states the results of those pN_ queries which SQL can express on whole tables."""

from __future__ import annotations

WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower(coalesce(natural_language, '') || ' ' || coalesce(sql, '')), '[^\p{L}\p{N}]+'), lambda x: x <> ''))"
SPLIT = r"""(CASE WHEN trim(lower(split)) IN ('train', 'training') THEN 'train' WHEN trim(lower(split)) IN ('validation', 'valid', 'val', 'dev') THEN 'validation'
  WHEN trim(lower(split)) IN ('test', 'testing', 'holdout') THEN 'test' END)"""


def _key(x: str) -> str:
    return rf"regexp_replace(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}]+', '', 'g')"


def _label(x: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({x}), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), '[\s\p{{Z}}_-]+', '_', 'g')"


def _records(id_col: str) -> str:
    return f"SELECT {id_col} AS id, {WORDS} AS w, {_key('natural_language')} || chr(0) || {_key('sql')} AS k"


def _copies(table: str, rows: str) -> str:
    return f"SELECT '{table}' AS table_name, m AS keep_id, id AS copy_id FROM (SELECT id, min(id) OVER (PARTITION BY {_key('nl')}, {_key('q')}) AS m FROM {rows}) WHERE id <> m"


def _counts(table: str, rows: str) -> str:
    return f"SELECT '{table}' AS table_name, min(id) AS keep_id, count(*) AS n_copies FROM {rows} GROUP BY {_key('nl')}, {_key('q')}"


def _pairs(source: str, left: str, right: str, more: str) -> str:
    """Pairs of records whose word overlap is 0.8 or more: candidates share a word among the rarest fifth of either."""
    return f"""WITH r AS ({source}), w AS (SELECT id, len(w) AS n, unnest(w) AS t FROM r), f AS (SELECT t, count(*) AS c FROM w GROUP BY 1),
      k AS (SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY c, t) AS p FROM w JOIN f USING (t)),
      c AS (SELECT DISTINCT a.id AS a, b.id AS b FROM k a JOIN k b USING (t) WHERE a.id < b.id AND a.p <= a.n - ceil(0.8 * a.n) + 1 AND b.p <= b.n - ceil(0.8 * b.n) + 1 AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
      v AS (SELECT x.id AS a, y.id AS b, len(list_intersect(x.w, y.w)) AS s, len(x.w) + len(y.w) AS n FROM c JOIN r x ON c.a = x.id JOIN r y ON c.b = y.id WHERE {more})
      SELECT a AS {left}, b AS {right} FROM v WHERE 9 * s >= 4 * n"""


_LINES = """(SELECT line_id AS id, coalesce(line ->> '$.natural_language', line ->> '$.nl') AS nl, line ->> '$.sql' AS q FROM raw_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT')"""
_EXAMPLES = "(SELECT example_id AS id, natural_language AS nl, sql AS q FROM generated_examples)"
_NEEDS = f"""(SELECT t.target_id, t.plan_id, floor(t.sample_fraction * n)::BIGINT AS sample_size, greatest(t.min_rows, floor(t.target_share * floor(t.sample_fraction * n) + 0.5))::BIGINT AS needed,
    (SELECT count(*) FROM generated_examples e WHERE (t.difficulty IS NULL OR {_label('e.difficulty')} = {_label('t.difficulty')}) AND (t.category IS NULL OR {_label('e.category')} = {_label('t.category')})) AS matching
  FROM sampling_targets t, (SELECT count(*) AS n FROM generated_examples))"""


# of a plan whose minimums fit in its sample, the sample has its size, or all rows that any target matches
_DRAWN = f"""SELECT p.plan_id, least(max(p.size), count(*))::BIGINT AS n_drawn, least(max(p.size), count(*))::BIGINT AS n_ids FROM (SELECT DISTINCT plan_id, floor(sample_fraction * (SELECT count(*) FROM generated_examples))::BIGINT AS size FROM sampling_targets) p
  JOIN generated_examples e ON EXISTS (SELECT 1 FROM sampling_targets t WHERE t.plan_id = p.plan_id AND (t.difficulty IS NULL OR {_label('e.difficulty')} = {_label('t.difficulty')}) AND (t.category IS NULL OR {_label('e.category')} = {_label('t.category')})) GROUP BY 1"""
_NODES = f"SELECT id, min(id) OVER (PARTITION BY list_sort(w)) AS c FROM (SELECT example_id AS id, {WORDS} AS w FROM generated_examples) WHERE len(w) > 0"
_CLOSE = _pairs(f"{_records('example_id')} FROM generated_examples", "a", "b", "list_sort(x.w) <> list_sort(y.w)")
_GROUPS = f"""WITH RECURSIVE n AS ({_NODES}), l AS (SELECT DISTINCT x.c AS a, y.c AS b FROM ({_CLOSE}) p JOIN n x ON x.id = p.a JOIN n y ON y.id = p.b),
  e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), d AS (SELECT a, count(*) AS n FROM e GROUP BY 1),
  r AS (SELECT DISTINCT c AS x, c AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.x WHERE r.root < e.b)
  SELECT n.id AS example_id, n.c AS class_id, g.root AS group_id, coalesce(d.n, 0)::BIGINT AS n_links FROM n JOIN (SELECT x, min(root) AS root FROM r GROUP BY 1) g ON g.x = n.c LEFT JOIN d ON d.a = n.c
  UNION ALL SELECT example_id, example_id, example_id, 0 FROM generated_examples WHERE len({WORDS}) = 0"""
_OVERLAPS = _pairs(f"{_records('seed_id')}, {SPLIT} AS split FROM seeds WHERE {SPLIT} IS NOT NULL", "a", "b", "(x.split = 'train') <> (y.split = 'train')")
_OVERLAP_REPORT = f"""WITH p AS ({_OVERLAPS}), s AS (SELECT seed_id AS id, {SPLIT} AS split, source, {_key('natural_language')} || chr(0) || {_key('sql')} AS k FROM seeds),
  q AS (SELECT CASE WHEN x.split = 'train' THEN x.id ELSE y.id END AS t, CASE WHEN x.split = 'train' THEN y.id ELSE x.id END AS e, x.k = y.k AS same FROM p JOIN s x ON x.id = p.a JOIN s y ON y.id = p.b)
  SELECT s.split AS eval_split, s.source AS eval_source, count(*) AS n_pairs, count(DISTINCT e) AS n_eval_rows, count(DISTINCT t) AS n_train_rows, count(*) FILTER (same) AS n_same_format FROM q JOIN s ON s.id = q.e GROUP BY 1, 2"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"SELECT target_id FROM {_NEEDS} WHERE matching < needed",
        "p2_found": _pairs(f"{_records('example_id')} FROM generated_examples", "example_id_a", "example_id_b", "x.k <> y.k"),
        "p4_found": _pairs(f"{_records('seed_id')}, {SPLIT} AS split FROM seeds WHERE {SPLIT} IS NOT NULL", "seed_id_a", "seed_id_b", "(x.split = 'train') <> (y.split = 'train')"),
        "p1_needs": f"SELECT target_id, plan_id, sample_size, needed, matching, greatest(0, needed - matching) AS short FROM {_NEEDS}",
        "p1_plan_sizes": _DRAWN,
        "p2_groups": _GROUPS,
        "p3_checks": "SELECT (SELECT count(*) FROM seeds) + (SELECT count(*) FROM generation_jobs) AS n_rows, 0::BIGINT AS n_torn, 0::BIGINT AS n_far",
        "p4_report": _OVERLAP_REPORT,
        "p8_checks": "SELECT spec_id, (SELECT count(*) FROM documents WHERE text <> '') AS n_items, 0::BIGINT AS n_tokens_lost, 0::BIGINT AS n_overfull, 0::BIGINT AS n_cut FROM container_specs WHERE tokenizer = 'byte_bpe_50k'",
        "p8_mixture": "SELECT source, count(*) AS n_items FROM documents WHERE text <> '' GROUP BY 1",
        "p6_found": _copies("generated_examples", _EXAMPLES) + " UNION ALL " + _copies("raw_lines", _LINES),
        "p6_counts": _counts("generated_examples", _EXAMPLES) + " UNION ALL " + _counts("raw_lines", _LINES),
    }
