"""The registered queries as SQL, written independently of the Spark plans."""

from __future__ import annotations

from tessera_spark.functions.permutation import PRIME, round_keys
from tessera_spark.operators.logs import KEEP_PATTERNS, NOISE_PATTERNS
from tessera_spark.plans import catalog, tables

STEP_HIDDEN = catalog.STEP_HIDDEN
PER_CLASS, PATIENCE, HIDDEN, TOTAL = catalog.PER_CLASS, catalog.PATIENCE, catalog.HIDDEN, catalog.TOTAL_EPOCHS


def _case(column: str, values: dict[str, str], other: str | None = None) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    tail = f" ELSE '{other}'" if other is not None else ""
    return f"CASE {column} {cases}{tail} END"


# Vectors with their label; the document of the same number marks unlabelled ones.
VECTORS = """
v AS (
  SELECT e.vec_id AS embedding_index, e.embedding, e.label,
         COALESCE(d.source IN ('src0', 'src1'), FALSE) AS is_test,
         CASE WHEN COALESCE(d.source IN ('src0', 'src1'), FALSE) THEN -1 ELSE e.label END AS label_id,
         CASE WHEN COALESCE(d.source IN ('src0', 'src1'), FALSE) THEN 'test' ELSE 'class_' || e.label END AS label_name
  FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id),
vn AS (
  SELECT embedding_index, label_id, label_name, label_name || '_' || CASE WHEN embedding_index > 9999
         THEN CAST(embedding_index AS VARCHAR) ELSE lpad(CAST(embedding_index AS VARCHAR), 4, '0') END || '.png' AS image_name
  FROM v),
k AS (SELECT DISTINCT label AS label_id, 'class_' || label AS label_name FROM embeddings)
"""


def _split(source: str, key: str, label: str) -> str:
    """Stratified split of ``source`` as CTE ``s``: quotas by largest remainder."""
    return f"""
h AS (SELECT {key}, {label}, md5('42:' || CAST({key} AS VARCHAR)) AS digest FROM {source}),
c AS (SELECT {label}, count(*) AS n FROM h GROUP BY {label}),
t AS (SELECT {label}, n, CAST(sum(n) OVER () AS BIGINT) AS total,
             CAST(ceil(0.25 * (sum(n) OVER ())) AS BIGINT) AS val FROM c),
w AS (SELECT *, (val * n) // total AS whole, (val * n) % total AS rest FROM t),
q AS (SELECT {label}, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, {label})
             <= val - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM w),
s AS (SELECT h.{key}, h.{label}, CASE WHEN row_number() OVER (PARTITION BY h.{label} ORDER BY digest) <= quota
             THEN 'val' ELSE 'train' END AS split
      FROM h JOIN q ON q.{label} = h.{label})
"""


SPLIT = VECTORS + ", lab AS (SELECT * FROM v WHERE label_id >= 0)," + _split("lab", "embedding_index", "label_id")

# Class means of the train part as a linear layer, logits, first maximum and its probability.
SCORED = SPLIT + """,
x AS (SELECT embedding_index, CAST(unnest(embedding) AS DOUBLE) AS x,
             generate_subscripts(embedding, 1) AS dim FROM v),
m AS (SELECT s.label_id AS class_id, dim, avg(x) AS w FROM x JOIN s USING (embedding_index)
      WHERE split = 'train' GROUP BY s.label_id, dim),
l AS (SELECT embedding_index, class_id, sum(x * w) AS logit FROM x JOIN m USING (dim)
      GROUP BY embedding_index, class_id),
p AS (SELECT embedding_index, CAST(arg_max(class_id, logit) AS INTEGER) AS predicted_class,
             1 / sum(exp(logit - top)) AS confidence_score
      FROM (SELECT *, max(logit) OVER (PARTITION BY embedding_index) AS top FROM l)
      GROUP BY embedding_index),
r AS (SELECT v.embedding_index, v.label_id, p.predicted_class, p.confidence_score, s.split
      FROM v JOIN p USING (embedding_index) LEFT JOIN s ON s.embedding_index = v.embedding_index)
"""


def _counts(condition: str) -> str:
    return SCORED + f""",
cm AS (SELECT label_id AS true_id, predicted_class AS pred_id, count(*) AS n
       FROM r WHERE label_id >= 0 AND {condition} GROUP BY ALL)
"""


VAL_COUNTS = _counts("split = 'val'")

PER_CLASS_TOTALS = """,
tot AS (SELECT k.label_id, k.label_name,
               CAST(COALESCE((SELECT sum(n) FROM cm WHERE true_id = k.label_id), 0) AS BIGINT) AS support,
               CAST(COALESCE((SELECT sum(n) FROM cm WHERE pred_id = k.label_id), 0) AS BIGINT) AS predicted,
               CAST(COALESCE((SELECT sum(n) FROM cm WHERE true_id = k.label_id AND pred_id = k.label_id), 0) AS BIGINT) AS hits
        FROM k),
rep AS (SELECT label_id, label_name, support, predicted, hits,
               COALESCE(hits / NULLIF(predicted, 0), 0.0) AS precision,
               COALESCE(hits / NULLIF(support, 0), 0.0) AS recall,
               COALESCE(2 * hits / NULLIF(support + predicted, 0), 0.0) AS f1 FROM tot)
"""

REPORT = """
SELECT label_id, label_name, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support,
       CASE WHEN f1 >= 0.8 THEN 'Excellent' WHEN f1 >= 0.6 THEN 'Good' WHEN f1 >= 0.3 THEN 'Fair' ELSE 'Poor' END AS performance
FROM rep
"""

DENSE = """,
g AS (SELECT a.label_id AS true_id, b.label_id AS pred_id FROM k a, k b),
d AS (SELECT g.true_id, g.pred_id, COALESCE(cm.n, 0) AS n FROM g LEFT JOIN cm ON cm.true_id = g.true_id AND cm.pred_id = g.pred_id)
"""

RANKED = """,
rk AS (SELECT CAST(row_number() OVER (ORDER BY recall DESC, label_id) AS INTEGER) AS place, * FROM rep)
"""

# Documents as raw files, numbered in their folder; the test folder counts every file.
FILES = f"""
f AS (
  SELECT doc_id, n_chars,
         CASE WHEN source = 'src0' THEN 1 WHEN source = 'src1' THEN 2 ELSE 0 END AS src,
         CASE WHEN source = 'src0' THEN '' WHEN source = 'src1' THEN 'test_data' ELSE lang END AS folder,
         '/raw/' || CASE WHEN source = 'src0' THEN '' WHEN source = 'src1' THEN 'test_data/' ELSE lang || '/' END
           || doc_id || CASE WHEN source = 'src1' AND lang = 'de' THEN '.txt'
             ELSE {_case('source', tables.SUFFIX_OF_SOURCE, '.png')} END AS path
  FROM documents),
i AS (SELECT *, regexp_matches(lower(path), '\\.(png|jpg|jpeg|bmp)$') AS image FROM f),
n0 AS (SELECT *, row_number() OVER (PARTITION BY src, folder ORDER BY path) - 1 AS idx,
              row_number() OVER (ORDER BY src, folder, path) - 1 AS position
       FROM i WHERE image OR src = 2),
n1 AS (SELECT *, src = 0 AND idx >= {PER_CLASS} AS is_overflow,
              CASE WHEN idx > 9999 THEN CAST(idx AS VARCHAR) ELSE lpad(CAST(idx AS VARCHAR), 4, '0') END AS num
       FROM n0 WHERE image),
named AS (
  SELECT *, CASE WHEN src = 1 THEN 'test_root_' || num || '.png' WHEN src = 2 THEN 'test_orig_' || num || '.png'
                 WHEN is_overflow THEN 'test_' || folder || '_' || num || '.png'
                 ELSE folder || '_' || num || '.png' END AS image_name,
         CASE WHEN src = 0 AND NOT is_overflow THEN folder ELSE 'test' END AS label_name
  FROM n1)
"""


def _encoded(source: str = "named") -> str:
    return f""",
ids AS (SELECT label_name, row_number() OVER (ORDER BY min(position)) - 1 AS label_id
        FROM {source} WHERE label_name <> 'test' GROUP BY label_name),
mf AS (SELECT '/normalized/' || CASE WHEN n.label_name = 'test' THEN 'test_data' ELSE n.folder END || '/' || n.image_name AS image_path,
              n.image_name, n.label_name, n.label_name = 'test' AS is_test, n.path AS original_path,
              CAST(CASE WHEN n.label_name = 'test' THEN -1 ELSE ids.label_id END AS INTEGER) AS label_id,
              n.position, n.doc_id,
              row_number() OVER (ORDER BY n.position) - 1 AS embedding_index
       FROM {source} n LEFT JOIN ids ON ids.label_name = n.label_name)
"""


MANIFEST = FILES + _encoded()

RUNS = """
e AS (SELECT user_id AS run_id, event_id, ts, event_type, value / 1000 AS value,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS epoch FROM events)
"""


def _fold(order: str) -> str:
    """Early stopping as a walk over the epochs of all runs at once; ``order`` is the column
    reported as epoch."""
    return f"""
WITH RECURSIVE {RUNS},
walk AS (
  SELECT run_id, epoch, value AS best, {order} AS best_epoch, CAST(0 AS BIGINT) AS misses, CAST(NULL AS BIGINT) AS stop_epoch
  FROM e WHERE epoch = 0
  UNION ALL
  SELECT o.run_id, e.epoch,
         CASE WHEN e.value - 1e-7 > o.best THEN e.value ELSE o.best END,
         CASE WHEN e.value - 1e-7 > o.best THEN e.{order} ELSE o.best_epoch END,
         CASE WHEN e.value - 1e-7 > o.best THEN 0 ELSE o.misses + 1 END,
         CASE WHEN e.value - 1e-7 > o.best OR o.misses + 1 < {PATIENCE} THEN NULL ELSE e.{order} END
  FROM walk o JOIN e ON e.run_id = o.run_id AND e.epoch = o.epoch + 1
  WHERE o.stop_epoch IS NULL),
ended AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY epoch DESC) AS back FROM walk)
SELECT run_id, stop_epoch, best_epoch, best AS best_value, misses,
       (SELECT count(*) FROM e WHERE e.run_id = ended.run_id) AS epochs
"""


def _any(column: str, patterns) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in patterns) + ")"


_BLANKS = (
    "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || "
    "chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || "
    "chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || "
    "chr(8239) || chr(8287) || chr(12288)"
)


def _shown(table: str, source: str, turn: str) -> str:
    return f"""
WITH parts AS (SELECT {source} AS source, {turn} AS turn, string_split(text, chr(10)) AS p FROM {table}),
raw AS (SELECT source, turn, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS line_no, trim(unnest(p), {_BLANKS}) AS line FROM parts),
kept AS (SELECT * FROM raw WHERE line <> '' AND ({_any('lower(line)', KEEP_PATTERNS)} OR NOT {_any('lower(line)', NOISE_PATTERNS)})),
seen AS (SELECT *, lag(line) OVER (PARTITION BY source ORDER BY turn, line_no) AS before FROM kept)
SELECT source, turn, line_no, line FROM seen WHERE before IS NULL OR before <> line
"""


DATASETS = f"""
a AS (SELECT user_id || '_' || strftime(ts, '%Y%m%d') AS name,
             {_case('event_type', tables.ARTEFACT_OF_EVENT)} AS file_name FROM events),
inv AS (SELECT name, bool_or(file_name = 'image_classifier_data.csv') AS has_csv,
               bool_or(file_name = 'image_embeddings.npy') AS has_embeddings,
               bool_or(file_name = 'model.pth') AND bool_or(file_name = 'model_config.json') AS has_model
        FROM a GROUP BY name),
st AS (SELECT name, '/data/raw/' || name AS raw_path, '/data/normalized/' || name AS normalized_path,
              '/data/normalized/' || name || '/image_classifier_data.csv' AS csv_path,
              '/data/normalized/' || name || '/image_embeddings.npy' AS embeddings_path,
              '/data/normalized/' || name || '/model.pth' AS model_path, has_csv, has_embeddings, has_model,
              CASE WHEN NOT has_csv THEN 'needs_csv' WHEN NOT has_embeddings THEN 'needs_embeddings'
                   WHEN NOT has_model THEN 'ready_to_train' ELSE 'trained' END AS stage FROM inv)
"""

_DURATION = (
    "CAST(CAST(floor(elapsed / 3600) AS BIGINT) AS VARCHAR) || 'h ' || "
    "CAST(CAST(floor((elapsed % 3600) / 60) AS BIGINT) AS VARCHAR) || 'm ' || "
    "CAST(CAST(round_even(elapsed % 60, 0) AS BIGINT) AS VARCHAR) || 's'"
)


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Evaluation
    sql["class_report"] = f"WITH {VAL_COUNTS}{PER_CLASS_TOTALS}{REPORT}"
    sql["class_report_all"] = f"WITH {_counts('TRUE')}{PER_CLASS_TOTALS}{REPORT}"
    sql["confusion_long"] = f"WITH {VAL_COUNTS}{DENSE} SELECT true_id, pred_id, n FROM d"
    cells = ", ".join(
        f"CAST(COALESCE(sum(n) FILTER (pred_id = {i}), 0) AS BIGINT) AS class_{i}" for i in range(10)
    )
    sql["confusion_wide"] = f"""WITH {VAL_COUNTS}{DENSE}
SELECT d.true_id AS label_id, k.label_name AS true_label, {cells}
FROM d JOIN k ON k.label_id = d.true_id GROUP BY d.true_id, k.label_name"""
    sql["confusion_normalized"] = f"""WITH {VAL_COUNTS}{DENSE}
SELECT true_id, pred_id, n, round(n / NULLIF(sum(n) OVER (PARTITION BY true_id), 0), 6) AS share FROM d"""
    recall_bands = (
        "CASE WHEN recall >= 0.9 THEN 'Excellent' WHEN recall >= 0.7 THEN 'Good' "
        "WHEN recall >= 0.5 THEN 'Fair' ELSE 'Poor' END"
    )
    sql["recall_ranking"] = f"""WITH {VAL_COUNTS}{PER_CLASS_TOTALS}{RANKED}
SELECT place, label_id, label_name, round(recall, 6) AS recall, support AS samples, {recall_bands} AS performance FROM rk"""
    sql["confusion_summary"] = f"""WITH {VAL_COUNTS}{PER_CLASS_TOTALS}{RANKED}
SELECT round(sum(hits) / sum(support), 6) AS accuracy, CAST(sum(support) AS BIGINT) AS total, count(*) AS num_classes,
       arg_min(label_name, place) AS best_class, round(arg_min(recall, place), 6) AS best_recall,
       arg_max(label_name, place) AS worst_class, round(arg_max(recall, place), 6) AS worst_recall FROM rk"""
    sql["accuracy_macro_micro"] = f"""WITH {VAL_COUNTS}{PER_CLASS_TOTALS}
SELECT round(avg(recall), 6) AS macro_accuracy, round(avg(f1), 6) AS macro_f1, round(avg(precision), 6) AS macro_precision,
       round(avg(recall), 6) AS macro_recall, round(sum(hits) / sum(support), 6) AS micro_accuracy
FROM rep WHERE support + predicted > 0"""
    sql["overall_accuracy"] = f"""WITH {SCORED}
SELECT count(*) AS total, round(avg(CASE WHEN predicted_class = label_id THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM r WHERE split = 'val'"""
    sql["cross_entropy_loss"] = f"""WITH {SCORED},
loss AS (SELECT l.embedding_index, ln(sum(exp(logit))) - max(CASE WHEN class_id = s.label_id THEN logit END) AS loss
         FROM l JOIN s USING (embedding_index) WHERE split = 'val' GROUP BY l.embedding_index)
SELECT round(avg(loss), 6) AS loss, count(*) AS n FROM loss"""
    sql["confidence_stats"] = f"""WITH {SCORED},
tagged AS (SELECT CASE WHEN label_id >= 0 THEN 'labelled' ELSE 'unlabelled' END AS part, confidence_score AS c FROM r
           UNION ALL SELECT 'all', confidence_score FROM r)
SELECT part, round(avg(c), 6) AS mean_confidence, round(min(c), 6) AS min_confidence, round(max(c), 6) AS max_confidence,
       round(stddev_pop(c), 6) AS std_confidence, count(*) AS n FROM tagged GROUP BY part"""
    sql["prediction_distribution"] = f"""WITH {SCORED},
cnt AS (SELECT predicted_class AS label_id, count(*) AS n FROM r WHERE label_id = -1 GROUP BY predicted_class),
sh AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, label_id DESC) AS INTEGER) AS place, label_id, n,
              n / (sum(n) OVER ()) * 100 AS percentage FROM cnt)
SELECT place, sh.label_id, n, round(percentage, 6) AS percentage,
       repeat('#', CAST(floor(percentage / 100 * 15) AS INTEGER)) || repeat('-', 15 - CAST(floor(percentage / 100 * 15) AS INTEGER)) AS bar,
       COALESCE(k.label_name, 'Unknown_' || sh.label_id) AS label_name
FROM sh LEFT JOIN k ON k.label_id = sh.label_id"""
    sql["sample_predictions"] = f"""WITH {SCORED}
SELECT r.embedding_index, image_name AS file_name, 'class_' || predicted_class AS predicted_label,
       round(confidence_score, 6) AS confidence_score,
       CASE WHEN confidence_score >= 0.7 THEN 'High' WHEN confidence_score >= 0.4 THEN 'Medium' ELSE 'Low' END AS confidence_level
FROM r JOIN vn USING (embedding_index) WHERE r.label_id = -1
ORDER BY md5('42:' || CAST(r.embedding_index AS VARCHAR)), r.embedding_index LIMIT 8"""
    sql["validation_samples"] = f"""WITH {SCORED}
SELECT image_name, 'class_' || r.label_id AS true_label, 'class_' || predicted_class AS pred_label,
       round(confidence_score, 6) AS confidence,
       CASE WHEN predicted_class = r.label_id THEN 'CORRECT' ELSE 'WRONG' END AS correct
FROM r JOIN vn USING (embedding_index) WHERE split = 'val'
ORDER BY md5('42:' || CAST(r.embedding_index AS VARCHAR)), r.embedding_index LIMIT 10"""
    sql["decode_unknown"] = """
SELECT e.label, count(*) AS n, COALESCE(max(q.label_name), 'Unknown_' || e.label) AS label_name
FROM embeddings e LEFT JOIN (SELECT DISTINCT quality, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS label_name FROM labels) q
  ON q.quality = e.label GROUP BY e.label"""
    sql["label_quality_report"] = f"""WITH
k AS (SELECT DISTINCT quality AS label_id, 'quality_' || quality AS label_name FROM labels),
cm AS (SELECT quality AS true_id, 1 - toxic AS pred_id, count(*) AS n FROM labels GROUP BY ALL){PER_CLASS_TOTALS}{REPORT}"""

    # Splits
    sql["stratified_split"] = f"WITH {SPLIT} SELECT embedding_index, CAST(label_id AS INTEGER) AS label_id, split, TRUE AS stratified FROM s"
    sql["stratified_documents"] = f"WITH {_split('documents', 'doc_id', 'lang')} SELECT doc_id, lang, split, TRUE AS stratified FROM s"
    sql["random_split"] = """
SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)))
       <= ceil(0.25 * (count(*) OVER ())) THEN 'val' ELSE 'train' END AS split FROM documents"""
    sql["stratified_rank"] = """
SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rank FROM documents"""
    sql["split_counts"] = f"""WITH {VECTORS}
SELECT count(*) AS total, count(*) FILTER (label_id >= 0) AS labelled, count(*) FILTER (label_id = -1) AS unlabelled,
       CAST(max(label_id) + 1 AS INTEGER) AS num_classes, CAST(max(len(embedding)) AS INTEGER) AS input_size FROM v"""
    sql["class_counts"] = f"""WITH {VECTORS}
SELECT k.label_id, k.label_name, count(v.label_id) AS n FROM k LEFT JOIN v ON v.label_id = k.label_id GROUP BY k.label_id, k.label_name"""
    sql["class_coverage"] = f"""WITH {SPLIT}
SELECT k.label_id, k.label_name, count(s.label_id) AS rows, count(*) FILTER (split = 'train') AS train_rows,
       count(*) FILTER (split = 'train') = 0 AS missing_in_train, count(s.label_id) < 2 AS too_small
FROM k LEFT JOIN s ON s.label_id = k.label_id GROUP BY k.label_id, k.label_name"""
    sql["class_count_check"] = f"""WITH {SPLIT}, b AS (
SELECT CAST(max(label_id) + 1 AS INTEGER) AS num_classes, CAST(max(label_id) FILTER (split = 'train') + 1 AS INTEGER) AS train_classes FROM s)
SELECT *, num_classes IS DISTINCT FROM train_classes AS differs FROM b"""
    sql["value_range"] = f"""WITH {VECTORS}
SELECT CAST(min(label_id) AS INTEGER) AS min_label, CAST(max(label_id) AS INTEGER) AS max_label,
       round(CAST(min(list_min(embedding)) AS DOUBLE), 6) AS min_value, round(CAST(max(list_max(embedding)) AS DOUBLE), 6) AS max_value FROM v"""
    sql["batches"] = """
SELECT vec_id AS embedding_index,
       (row_number() OVER (ORDER BY md5('42:3:' || CAST(vec_id AS VARCHAR)), vec_id) - 1) // 256 AS batch FROM embeddings"""
    # The digits' bases need the number of rows; n numbers land at n or above at most so often in a row.
    rounds = round_keys("42:3")
    digits = "SELECT w, n, f, s, v // s AS h, v % s AS l FROM {0}"
    for k, (a, b, c) in enumerate(rounds):
        x, y, base = ("h", "l", "f") if k % 2 == 0 else ("l", "h", "s")
        moved = f"({x} + ({y} * {y} % {PRIME} * {a} % {PRIME} + {y} * {b} % {PRIME} + {c}) % {PRIME}) % {base} AS {x}"
        digits = f"SELECT w, n, f, s, {moved}, {y} FROM ({digits})"
    walked = digits.format("(SELECT vec_id AS w, v, n, CAST(ceil(sqrt(n)) AS BIGINT) AS f, CAST(ceil(n / ceil(sqrt(n))) AS BIGINT) AS s FROM walk WHERE turn = 0 OR v >= n)")
    sql["batches_permuted"] = f"""WITH RECURSIVE walk AS (
SELECT vec_id, vec_id AS v, (SELECT count(*) FROM embeddings) AS n, 0 AS turn FROM embeddings
UNION ALL SELECT w AS vec_id, h * s + l AS v, n, 1 AS turn FROM ({walked}))
SELECT vec_id AS embedding_index, CAST(v // 256 AS BIGINT) AS batch FROM walk WHERE turn = 1 AND v < n"""
    sql["batches_sequential"] = "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 256 AS batch FROM documents"
    sql["sample_info"] = f"""WITH {SPLIT},
sm AS (SELECT embedding_index FROM s WHERE split = 'val' ORDER BY md5('42:' || CAST(embedding_index AS VARCHAR)), embedding_index LIMIT 10)
SELECT vn.embedding_index, '/normalized/' || label_name || '/' || image_name AS image_path, image_name, label_name,
       CAST(label_id AS INTEGER) AS label_id
FROM vn JOIN sm USING (embedding_index)"""

    # Vectors
    cells_cte = """x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
             CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim FROM embeddings)"""
    moments = f"""{cells_cte},
st AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS scale, count(*) AS n FROM x GROUP BY dim)"""
    sql["scaler_stats"] = f"WITH {moments} SELECT dim, round(mean, 6) AS mean, round(scale, 6) AS scale, n FROM st"
    sql["standardize"] = f"WITH {moments} SELECT vec_id, dim, round((x - mean) / scale, 6) AS z FROM x JOIN st USING (dim)"
    sql["dim_check"] = "SELECT CAST(len(embedding) AS INTEGER) AS dimension, count(*) AS n FROM embeddings GROUP BY 1"
    sql["wrong_dimension"] = """
SELECT vec_id AS embedding_index, CASE WHEN vec_id % 10 = 9 THEN NULL ELSE CAST(2 * len(embedding) AS INTEGER) END AS dimension
FROM embeddings WHERE vec_id % 10 = 9 OR vec_id % 4 = 0"""
    sql["positional_check"] = f"""WITH {MANIFEST},
b AS (SELECT mf.embedding_index AS m, e.vec_id AS e FROM mf FULL JOIN embeddings e ON e.vec_id = mf.embedding_index)
SELECT count(m) AS manifest_rows, count(e) AS embedding_rows, count(*) FILTER (e IS NULL) AS manifest_only,
       count(*) FILTER (m IS NULL) AS embeddings_only,
       (SELECT count(*) FROM (SELECT vec_id FROM embeddings GROUP BY vec_id HAVING count(*) > 1)) AS duplicate_keys FROM b"""
    sql["attach_embeddings"] = f"""WITH {MANIFEST}
SELECT mf.embedding_index, mf.image_name, mf.label_id, CAST(len(e.embedding) AS INTEGER) AS dimension
FROM mf JOIN embeddings e ON e.vec_id = mf.embedding_index"""
    sql["softmax_rows"] = f"""WITH {cells_cte},
b AS (SELECT vec_id, max(x) AS top, max(label) AS label FROM x GROUP BY vec_id),
y AS (SELECT vec_id, min(dim) FILTER (x = top) AS best, 1 / sum(exp(x - top)) AS confidence,
             sum(exp(x - top)) FILTER (dim = b.label) / sum(exp(x - top)) AS lp,
             sum(CASE WHEN x < 0 THEN x * 0.02 ELSE x END) AS rs
      FROM x JOIN b USING (vec_id) GROUP BY vec_id)
SELECT vec_id, best AS top, round(confidence, 6) AS confidence, round(lp, 6) AS label_probability, round(rs, 6) AS rectified_sum FROM y"""
    sql["mlp_forward"] = f"""WITH {cells_cte},
u AS (SELECT unnest(range({HIDDEN})) AS j),
z AS (SELECT vec_id, j, sum(x * sin(j * 7.0 + dim)) + cos(j) AS z FROM x, u GROUP BY vec_id, j),
b AS (SELECT vec_id, j, (z - sin(j) / 10) / sqrt(1 + cos(j) * cos(j) + 1e-5) * (1 + sin(j + 1) / 2) + cos(j) / 10 AS b FROM z),
a AS (SELECT vec_id, j, CASE WHEN b < 0 THEN b * 0.02 ELSE b END AS a FROM b),
o AS (SELECT CAST(unnest(range((SELECT max(label) + 1 FROM embeddings))) AS INTEGER) AS c)
SELECT vec_id, c AS class_id, round(sum(a * sin(c * 7.0 + j)) + cos(c), 6) AS logit FROM a, o GROUP BY vec_id, c"""

    # Manifest
    sql["manifest"] = f"""WITH {MANIFEST}
SELECT image_path, image_name, label_name, is_test, original_path, label_id, CAST(NULL AS INTEGER) AS label_prediction FROM mf"""
    sql["normalized_names"] = f'WITH {FILES} SELECT path AS original_path, image_name, idx AS "index", is_overflow FROM named'
    sql["manifest_summary"] = f"""WITH {MANIFEST}
SELECT count(*) AS total, count(*) FILTER (NOT is_test) AS train_rows, count(*) FILTER (is_test) AS test_rows,
       count(DISTINCT label_name) FILTER (label_name <> 'test') AS labels FROM mf"""
    sql["moved_to_test"] = f"""WITH {FILES}
SELECT folder AS raw_label, count(*) AS moved FROM named WHERE is_overflow GROUP BY folder"""
    sql["label_ids"] = """
WITH ids AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY min(p_partkey)) - 1 AS INTEGER) AS label_id FROM part GROUP BY p_brand)
SELECT p_brand, label_id, count(*) AS n FROM part JOIN ids USING (p_brand) GROUP BY p_brand, label_id"""
    sql["class_names"] = "SELECT p_size AS label_id, arg_min(p_type, p_partkey) AS label_name FROM part WHERE p_size >= 0 GROUP BY p_size"
    sql["augment_fanout"] = f"""WITH {MANIFEST},
a AS (SELECT CAST(unnest(range(3)) AS INTEGER) AS aug_version)
SELECT CASE WHEN aug_version = 0 THEN embedding_index
            ELSE (SELECT count(*) FROM mf) + embedding_index * 2 + aug_version - 1 END AS embedding_index, aug_version, image_name
FROM mf, a"""
    sql["missing_files"] = f"WITH {MANIFEST} SELECT original_path, label_name FROM mf WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
    sql["existing_files"] = f"WITH {MANIFEST} SELECT original_path, label_name FROM mf WHERE doc_id IN (SELECT doc_id FROM labels)"
    sql["failed_images"] = f"""WITH {FILES},
kept AS (SELECT * FROM named WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)){_encoded('kept')}
SELECT original_path, image_name, label_id FROM mf"""
    sql["sentinel_check"] = """
WITH b AS (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'test' ELSE p_type END AS label_name, p_type = 'STANDARD' AS is_test FROM part),
ids AS (SELECT label_name, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS id FROM b WHERE label_name <> 'test' GROUP BY label_name),
c AS (SELECT b.*, CAST(CASE WHEN b.label_name = 'test' THEN -1 ELSE id END AS INTEGER) AS label_id FROM b LEFT JOIN ids ON ids.label_name = b.label_name)
SELECT p_partkey, label_name, is_test, label_id FROM c WHERE (label_id = -1) <> is_test OR (label_id = -1) <> (label_name = 'test')"""
    plain = "regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '[?#].*$', '')"
    sql["path_functions"] = f"""WITH b AS (SELECT page_id, url, {plain} AS plain FROM pages)
SELECT page_id, plain, regexp_extract(plain, '[^/]*$') AS name,
       '/a' || regexp_replace(rtrim(plain, '/'), '/[^/]*$', '') AS normalised,
       '/work' || rtrim(plain, '/') AS absolute,
       regexp_matches(lower(url), '\\.(png|jpg|jpeg|bmp)$') AS is_image,
       CASE WHEN length(url) > 30 THEN left(url, 27) || '...' ELSE url END AS short FROM b"""
    sql["output_folders"] = """
SELECT source, count(*) AS n, CASE WHEN source = 'src1' THEN '/given/folder' WHEN source = 'src0' THEN '/in/normalized_' || source
       ELSE '/project/datasets/normalized/' || source END AS folder FROM documents GROUP BY source"""

    # Runs, logs, inventory
    sql["best_epoch"] = f"""WITH {RUNS},
o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY value DESC, epoch) AS place, max(epoch) OVER (PARTITION BY run_id) AS last_epoch FROM e)
SELECT run_id, epoch AS best_epoch, value AS best_value, last_epoch FROM o WHERE place = 1"""
    sql["early_stop"] = _fold("epoch") + "FROM ended WHERE back = 1"
    sql["early_stop_stream"] = _fold("event_id") + ", CAST(0 AS BIGINT) AS late FROM ended WHERE back = 1"
    sql["early_stop_batches"] = sql["early_stop_stream"]
    sql["epoch_progress"] = f"""WITH {RUNS},
b AS (SELECT run_id, epoch, epoch / {TOTAL} * 100 AS percent,
             (epoch_us(ts) - epoch_us(first(ts) OVER o)) / 1e6 AS elapsed,
             (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 1e6 AS epoch_seconds
      FROM e WINDOW o AS (PARTITION BY run_id ORDER BY epoch))
SELECT run_id, epoch, round(percent, 6) AS percent,
       repeat('#', CAST(floor(percent / 5) AS INTEGER)) || repeat('-', 20 - CAST(floor(percent / 5) AS INTEGER)) AS bar,
       round(elapsed, 6) AS elapsed, {_DURATION} AS elapsed_text,
       round(CASE WHEN epoch > 0 THEN elapsed / epoch * ({TOTAL} - epoch) END, 3) AS eta, round(epoch_seconds, 6) AS epoch_seconds FROM b"""
    sql["val_cadence"] = f"""WITH {RUNS}
SELECT run_id, epoch, CAST(epoch // 5 + 1 AS INTEGER) AS validation_run, epoch % 25 = 0 OR (epoch // 5 + 1) % 5 = 0 AS sampled
FROM e WHERE epoch % 5 = 4"""
    sql["lr_schedule"] = f"""WITH {RUNS}
SELECT run_id, epoch, round((1e-6 + (5e-5 - 1e-6) * (1 + cos(pi() * epoch / {TOTAL})) / 2) * 1e6, 6) AS cosine_micro,
       round(CASE WHEN epoch < 20 THEN 2e-4 / 1e-6 * (epoch / 20) ELSE 0.5 * (1 + cos(pi() * (epoch - 20) / ({TOTAL} - 20))) END, 6) AS warmup_cosine,
       round(CASE WHEN epoch < 20 THEN 3e-3 / 1e-4 * (epoch / 20) ELSE 1.0 END, 6) AS warmup_constant FROM e"""
    series = ", ".join(
        f"COALESCE(arg_max(value, epoch) FILTER (event_type = '{kind}'), 0.0) AS {phase}_{name}"
        for kind, (phase, name) in tables.SERIES_OF_EVENT.items()
    )
    sql["progress_flags"] = f"""WITH {RUNS},
b AS (SELECT run_id, {series}, 0.0::DOUBLE AS train_f1_score FROM e GROUP BY run_id)
SELECT run_id, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss, round(train_acc, 6) AS train_acc,
       round(val_acc, 6) AS val_acc, round(train_f1_score, 6) AS train_f1_score, round(val_f1_score, 6) AS val_f1_score,
       CASE WHEN val_loss > 0 AND train_loss > val_loss THEN 'DOWN' WHEN val_loss > 0 THEN 'UP' ELSE 'WAIT' END AS loss_flag,
       CASE WHEN val_acc > 0.8 THEN 'GOOD' WHEN val_acc > 0.5 THEN 'OK' ELSE 'TRAIN' END AS acc_flag,
       CASE WHEN val_f1_score > 0.8 THEN 'GREAT' WHEN val_f1_score > 0.5 THEN 'GOOD' ELSE 'TRAIN' END AS f1_flag FROM b"""
    sql["run_events"] = f"""WITH {RUNS}
SELECT run_id, {_case('event_type', tables.KIND_OF_EVENT)} AS kind, CAST(epoch AS INTEGER) AS epoch,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, event_id FROM e"""
    sql["run_registry"] = """
WITH b AS (SELECT CAST(user_id AS VARCHAR) AS dataset, CAST(event_id AS VARCHAR) AS run_id, event_type,
                  row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, ts DESC, CAST(event_id AS VARCHAR)) AS place
           FROM events)
SELECT dataset, run_id, event_type AS project, event_type || '-' || run_id AS name,
       event_type || '|testing|evaluation|confusion_matrix' AS tags FROM b WHERE place = 1"""
    sql["dataset_inventory"] = f"""WITH {DATASETS}
SELECT *, CASE stage WHEN 'needs_csv' THEN 'csv' WHEN 'needs_embeddings' THEN 'embeddings' WHEN 'ready_to_train' THEN 'train' END AS start_from FROM st"""
    sql["stage_ready"] = f"""WITH {DATASETS}
SELECT name, has_csv AS can_embed, has_csv AND has_embeddings AS can_train, has_csv AND has_embeddings AND has_model AS can_evaluate FROM st"""
    sql["dataset_lookup"] = f"WITH {DATASETS} SELECT * FROM st WHERE name = '1_20240101'"
    sql["stage_summary"] = f"""
WITH s(place, stage_name, stage) AS (VALUES (0, 'CSV Generation', 'csv_generation'), (1, 'Embedding Generation', 'embedding_generation'),
                             (2, 'Model Training', 'model_training'), (3, 'Model Testing', 'model_testing')),
b AS (SELECT {_case('event_type', tables.STAGE_OF_EVENT)} AS stage, ts, event_type <> 'signup' AS completed,
             '/data/normalized/some/long/folder/of/the/run/number/' || event_id AS output FROM events),
l AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, completed DESC, output DESC) AS place FROM b)
SELECT s.place, s.stage_name, COALESCE(completed, FALSE) AS completed,
       CASE WHEN completed THEN strftime(ts, '%H:%M:%S') ELSE 'N/A' END AS completion_time,
       CASE WHEN NOT COALESCE(completed, FALSE) THEN 'N/A' WHEN length(output) > 50 THEN left(output, 47) || '...' ELSE output END AS output
FROM s LEFT JOIN l ON l.stage = s.stage AND l.place = 1"""
    sql["log_filter"] = _shown("conversations", "conv_id", "turn")
    sql["log_filter_stream"] = sql["log_filter"]
    sql["log_filter_by_time"] = sql["log_filter"]
    sql["log_filter_documents"] = _shown("documents", "source", "doc_id")

    # Images and models
    sql["wrong_size"] = """
SELECT '/normalized/' || vec_id || '.png' AS image_path, 224 AS width, CAST(sqrt(len(embedding)) AS INTEGER) AS height
FROM embeddings WHERE vec_id % 3 = 0"""
    levels = """px AS (SELECT vec_id, '/normalized/' || vec_id || '.png' AS image_path, CAST(sqrt(len(embedding)) AS INTEGER) AS side,
       list_transform(embedding, lambda v: CAST(round((v::DOUBLE + 1) * 127.5) AS INTEGER)) AS p FROM embeddings)"""
    sql["image_resize"] = f"""WITH {levels}
SELECT image_path, 224 AS height, 224 AS width, 1 AS "nChannels", md5(array_to_string(list_transform(range(224 * 224),
       lambda i: lpad(upper(to_hex(p[((i // 224) * side // 224) * side + (i % 224) * side // 224 + 1])), 2, '0')), '')) AS pixels_md5 FROM px"""
    sql["image_augment"] = f"""WITH {levels},
two AS (SELECT *, 0 AS aug_version, p AS q FROM px UNION ALL
        SELECT *, 1, list_transform(range(side * side), lambda i: least(255, p[(i // side) * side + side - i % side] + 40)) FROM px)
SELECT image_path, aug_version, side AS height, side AS width,
       array_to_string(list_transform(q, lambda v: lpad(upper(to_hex(v)), 2, '0')), '') AS pixels FROM two"""
    sql["embed_images"] = f"""WITH
px AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i,
              round((CAST(unnest(embedding) AS DOUBLE) + 1) * 127.5) AS level FROM embeddings),
m AS (SELECT vec_id FROM px GROUP BY vec_id HAVING avg(level) > {catalog.BRIGHTEST}),
u AS (SELECT CAST(unnest(range({catalog.ENCODED})) AS INTEGER) AS dim)
SELECT '/normalized/' || vec_id || '.png' AS image_path, CAST(NULL AS VARCHAR) AS error, dim,
       round(CAST(CAST(sum(level / 255.0 * (sin(3 * i * 7.0 + dim) + sin((3 * i + 1) * 7.0 + dim) + sin((3 * i + 2) * 7.0 + dim))) AS FLOAT) AS DOUBLE), 6) AS value
FROM px, u WHERE vec_id NOT IN (FROM m) GROUP BY vec_id, dim
UNION ALL SELECT '/normalized/' || vec_id || '.png', 'too bright', NULL, NULL FROM m"""
    sql["model_sources"] = """
WITH n AS (SELECT CASE p_size WHEN 1 THEN 'ViT-SO400M-14-SigLIP-384' WHEN 2 THEN 'ViT-B-16-SigLIP-512' WHEN 3 THEN 'ViT-L-14-SigLIP-384' ELSE p_name END AS p_name
           FROM part)
SELECT p_name, count(*) AS n,
       CASE WHEN p_name IN ('ViT-SO400M-14-SigLIP-384', 'ViT-B-16-SigLIP-512', 'ViT-L-14-SigLIP-384') THEN 'hf-hub:timm' ELSE p_name END AS hub,
       CASE WHEN p_name IN ('ViT-SO400M-14-SigLIP-384', 'ViT-B-16-SigLIP-512', 'ViT-L-14-SigLIP-384') THEN p_name ELSE 'openai' END AS name
FROM n GROUP BY p_name"""
    sql["score_stream"] = f"""WITH {SCORED}
SELECT v.embedding_index AS vec_id, v.label, r.predicted_class, round(r.confidence_score, 6) AS confidence_score
FROM r JOIN v USING (embedding_index)"""
    # Round trips: what comes back is what the stage had made.
    for name, same in (
        ("manifest_table", "manifest"), ("manifest_csv", "manifest"), ("processors_table", "standardize"), ("results_table", "class_report_all"),
        ("results_csv", "class_report_all"), ("evaluation_report", "class_report"), ("epoch_metrics_table", "best_epoch"),
        ("run_lines_table", "run_events"), ("embedding_index_of_images", "augment_fanout"),
    ):
        sql[name] = sql[same]
    sql["train_test_rows"] = f"""
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, label_name, count(*) AS n FROM ({sql["manifest"]}) GROUP BY ALL"""
    sql["confusion_csv"] = f"SELECT * EXCLUDE (label_id) FROM ({sql['confusion_wide']})"
    sql["embeddings_table"] = f"""WITH {VECTORS}
SELECT v.embedding_index, '/normalized/' || vn.label_name || '/' || image_name AS image_path, CAST(len(embedding) AS INTEGER) AS dimension,
       round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 3) AS total
FROM v JOIN vn ON vn.embedding_index = v.embedding_index"""
    sql["model_config_json"] = """
SELECT CAST(max(len(embedding)) AS INTEGER) AS input_size, CAST(count(DISTINCT label) AS INTEGER) AS num_classes, '16-8' AS hidden,
       string_agg(DISTINCT 'class_' || label, ',' ORDER BY 'class_' || label) AS classes FROM embeddings"""
    sql["layers_table"] = f"""WITH {VECTORS},
c AS (SELECT label_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM v WHERE label_id >= 0)
SELECT CAST(label_id AS INTEGER) AS label_id, CAST(dim AS INTEGER) AS dim, round(avg(x::DOUBLE), 6) AS mean FROM c GROUP BY ALL"""
    sql["standardize_with_nulls"] = """WITH
c AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings WHERE vec_id % 10 <> 0),
m AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS scale FROM c GROUP BY dim),
z AS (SELECT vec_id, round(sum(((x - mean) / scale) ** 2), 4) AS squares FROM c JOIN m USING (dim) GROUP BY vec_id)
SELECT vec_id, squares FROM embeddings LEFT JOIN z USING (vec_id)"""
    sql["pca_check"] = """WITH
c AS (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
m AS (SELECT dim, avg(x) AS mean, stddev_pop(x) AS scale FROM c GROUP BY dim),
t AS (SELECT round(sum(v), 6) AS total FROM (SELECT avg(((x - mean) / scale) ** 2) AS v FROM c JOIN m USING (dim) WHERE scale > 0 GROUP BY dim))
SELECT CAST(i AS INTEGER) AS component, 0.0::DOUBLE AS residual, 0.0::DOUBLE AS overlap, 1.0::DOUBLE AS length, total FROM range(8) r(i), t"""
    sql["pca_check_randomized"] = sql["pca_check"]
    sql["mlp_step"] = f"""WITH {cells_cte},
o AS (SELECT CAST(unnest(range((SELECT max(label) + 1 FROM embeddings))) AS INTEGER) AS c),
l AS (SELECT vec_id, label, c, sum(x * sin(c * 7.0 + dim)) + cos(c) AS z FROM x, o GROUP BY vec_id, label, c),
p AS (SELECT vec_id, c, exp(z) / sum(exp(z)) OVER (PARTITION BY vec_id) - CASE WHEN c = label THEN 1 ELSE 0 END AS d FROM l)
SELECT c AS class_id, dim, round(sin(c * 7.0 + dim) - 0.01 * sign(sum(d * x)), 6) AS weight FROM p JOIN x USING (vec_id) GROUP BY c, dim"""
    sql["attach_embeddings_bucketed"] = sql["attach_embeddings"]
    sql["score_stream_replayed"] = sql["score_stream"]
    sql["npy_round_trip"] = """
SELECT vec_id AS embedding_index, CAST(len(embedding) AS INTEGER) AS dimension, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 3) AS total FROM embeddings"""
    sql["project_rows"] = f"""WITH {cells_cte}, u AS (SELECT CAST(unnest(range({catalog.PROJECTED})) AS INTEGER) AS component)
SELECT vec_id, component, round(sum((x - cos(dim * 1.0)) * sin(component * 7.0 + dim)), 6) AS value FROM x, u GROUP BY vec_id, component"""
    sql["feature_noise"] = f"""WITH {cells_cte},
h AS (SELECT *, md5('42:' || vec_id || ':' || dim) AS h FROM x),
d AS (SELECT vec_id, dim, x, list_transform([1, 11, 21], lambda k: (('0x' || substr(h, k, 10))::BIGINT + 0.5::DOUBLE) / 1099511627776.0::DOUBLE) AS u FROM h)
SELECT vec_id, dim, CASE WHEN u[3] < 0.9 THEN round(x + 0.1 * (sqrt(-2 * ln(u[1])) * cos(2 * pi() * u[2])), 6) ELSE 0.0::DOUBLE END AS value FROM d"""
    sql["number_texts"] = """
SELECT event_type, format('{:,}', count(*) * 1000) AS thousands, printf('%.3f%%', 100.0 * count(*) / sum(count(*)) OVER ()) AS share, printf('%.3f', sum(value)) AS total
FROM events GROUP BY event_type"""
    sql["config_text"] = """
SELECT s_suppkey, CAST(to_json({'s_name': s_name, 'nation': s_nationkey, 'keys': [s_suppkey, s_nationkey]}) AS VARCHAR) AS json, s_name, CAST(s_nationkey AS BIGINT) AS second FROM supplier"""
    sql["mlp_three_steps"] = _three_steps(cells_cte)
    return sql


def _three_steps(cells_cte: str) -> str:
    """Three updates of a network with one normalised hidden layer, each as a chain of sums."""
    eps, slope = 1e-5, 0.02
    parts = [
        cells_cte,
        "rs AS (SELECT DISTINCT vec_id, label FROM x)",
        f"hid AS (SELECT CAST(unnest(range({STEP_HIDDEN})) AS INTEGER) AS j)",
        "cls AS (SELECT CAST(unnest(range((SELECT max(label) + 1 FROM embeddings))) AS INTEGER) AS c)",
        "p0 AS (SELECT 0 AS layer, 'weight' AS kind, j AS r, dim AS q, sin(j * 7.0 + dim) AS v, 0.0 AS m FROM hid, (SELECT DISTINCT dim FROM x)"
        " UNION ALL SELECT 0, 'bn_gamma', j, 0, 1 + sin(j + 1.0) / 2, 0.0 FROM hid UNION ALL SELECT 0, 'bn_beta', j, 0, cos(j * 1.0) / 10, 0.0 FROM hid"
        " UNION ALL SELECT 1, 'weight', c, j, sin(c * 7.0 + j), 0.0 FROM cls, hid UNION ALL SELECT 1, 'bias', c, 0, cos(c * 1.0), 0.0 FROM cls)",
    ]
    for k in range(3):
        p = f"p{k}"

        def of(layer: int, kind: str, p: str = p) -> str:
            return f"(SELECT r, q, v FROM {p} WHERE layer = {layer} AND kind = '{kind}')"

        parts += [
            # Inputs of the hidden layer, normalised over all rows; the bias would cancel out.
            f"z{k} AS MATERIALIZED (SELECT vec_id, r AS j, sum(x * v) AS z FROM x JOIN {of(0, 'weight')} ON q = dim GROUP BY vec_id, r)",
            f"n{k} AS (SELECT j, avg(z) AS mu, var_pop(z) AS va FROM z{k} GROUP BY j)",
            f"u{k} AS MATERIALIZED (SELECT vec_id, j, (z - mu) / sqrt(va + {eps}) AS u, 1 / sqrt(va + {eps}) AS w FROM z{k} JOIN n{k} USING (j))",
            f"y{k} AS MATERIALIZED (SELECT vec_id, j, u, w, g.v AS gamma, u * g.v + b.v AS y FROM u{k} JOIN {of(0, 'bn_gamma')} g ON g.r = j JOIN {of(0, 'bn_beta')} b ON b.r = j)",
            f"h{k} AS MATERIALIZED (SELECT *, CASE WHEN y < 0 THEN {slope} ELSE 1 END AS sl, y * CASE WHEN y < 0 THEN {slope} ELSE 1 END AS h FROM y{k})",
            f"l{k} AS (SELECT vec_id, o.r AS c, sum(h * o.v) + any_value(b.v) AS l FROM h{k} JOIN {of(1, 'weight')} o ON o.q = j JOIN {of(1, 'bias')} b ON b.r = o.r GROUP BY vec_id, o.r)",
            f"d{k} AS MATERIALIZED (SELECT vec_id, c, exp(l) / sum(exp(l)) OVER (PARTITION BY vec_id) - CASE WHEN c = label THEN 1 ELSE 0 END AS d FROM l{k} JOIN rs USING (vec_id))",
            f"e{k} AS MATERIALIZED (SELECT vec_id, j, u, w, gamma, sum(d * o.v) * any_value(sl) AS e FROM h{k} JOIN d{k} USING (vec_id) JOIN {of(1, 'weight')} o ON o.q = j AND o.r = c GROUP BY vec_id, j, u, w, gamma)",
            f"s{k} AS (SELECT j, avg(e * gamma) AS s1, avg(e * gamma * u) AS s2 FROM e{k} GROUP BY j)",
            f"b{k} AS MATERIALIZED (SELECT vec_id, j, w * (e * gamma - s1 - u * s2) AS b FROM e{k} JOIN s{k} USING (j))",
            f"g{k} AS (SELECT 0 AS layer, 'weight' AS kind, j AS r, dim AS q, sum(b * x) AS g FROM b{k} JOIN x USING (vec_id) GROUP BY j, dim"
            f" UNION ALL SELECT 0, 'bn_gamma', j, 0, sum(e * u) FROM e{k} GROUP BY j UNION ALL SELECT 0, 'bn_beta', j, 0, sum(e) FROM e{k} GROUP BY j"
            f" UNION ALL SELECT 1, 'weight', c, j, sum(d * h) FROM d{k} JOIN h{k} USING (vec_id) GROUP BY c, j UNION ALL SELECT 1, 'bias', c, 0, sum(d) FROM d{k} GROUP BY c)",
            f"p{k + 1} AS MATERIALIZED (SELECT layer, kind, r, q, v - 0.01 * sign(0.95 * m + 0.05 * g / (SELECT count(*) FROM rs)) AS v,"
            f" 0.98 * m + 0.02 * g / (SELECT count(*) FROM rs) AS m FROM {p} JOIN g{k} USING (layer, kind, r, q))",
        ]
    return f"WITH {','.join(parts)} SELECT CAST(layer AS INTEGER) AS layer, kind, CAST(r AS INTEGER) AS row, CAST(q AS INTEGER) AS col, round(CAST(v AS DOUBLE), 6) AS value FROM p3"
