"""DuckDB oracle SQL for each registered query (same column names).

Thresholds are written as ``x::DOUBLE`` so ``ceil`` sees the same double
arithmetic as Spark (a bare 0.24 is DECIMAL in DuckDB).
"""

from __future__ import annotations

from ..functions.text import ENGLISH_STOP_WORDS
from . import extended
from .catalog import (BRAND_SUPPORT, DAMPING, FP_SUPPORT, NB_FOLDS, NB_SMOOTHING, PART_SUPPORT, RANK_ROUNDS,
                      RULE_CONFIDENCE, RULE_SUPPORT, SHINGLE_K, SIM_THRESHOLD, SIM_THRESHOLD_LOW,
                      SUPPLIER_SUPPORT, TYPE_SUPPORT)

WS = "[ \\t\\n\\x0B\\f\\r]"


def _baskets(attr: str, distinct: bool = True) -> str:
    d = "DISTINCT " if distinct else ""
    return (f"SELECT {d}l.l_orderkey AS basket, p.{attr} AS item "
            f"FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey")


def _apriori_ctes(attr: str, s: float) -> str:
    return f"""
    b AS ({_baskets(attr)}),
    t AS (SELECT CAST(ceil({s}::DOUBLE * count(DISTINCT basket)) AS BIGINT) AS thr FROM b),
    c AS (SELECT item, count(*) AS n FROM b GROUP BY item),
    f AS (SELECT item FROM c, t WHERE n >= thr),
    bf AS (SELECT basket, item FROM b WHERE item IN (SELECT item FROM f)),
    pc AS (SELECT x.item AS item_a, y.item AS item_b, count(*) AS n
           FROM bf x JOIN bf y ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2)"""


def _itemsets_ctes(attr: str, s: float) -> str:
    """Frequent 1-, 2- and 3-itemsets (items in ascending order)."""
    return f"""
    b AS ({_baskets(attr)}),
    t AS (SELECT CAST(ceil({s}::DOUBLE * count(DISTINCT basket)) AS BIGINT) AS thr,
                 count(DISTINCT basket) AS n FROM b),
    s1 AS (SELECT item AS i1, count(*) AS freq FROM b GROUP BY item
           HAVING count(*) >= (SELECT thr FROM t)),
    bf AS (SELECT basket, item FROM b WHERE item IN (SELECT i1 FROM s1)),
    s2 AS (SELECT x.item AS i1, y.item AS i2, count(*) AS freq
           FROM bf x JOIN bf y ON x.basket = y.basket AND x.item < y.item
           GROUP BY 1, 2 HAVING count(*) >= (SELECT thr FROM t)),
    s3 AS (SELECT x.item AS i1, y.item AS i2, z.item AS i3, count(*) AS freq
           FROM bf x JOIN bf y ON x.basket = y.basket AND x.item < y.item
                     JOIN bf z ON z.basket = x.basket AND y.item < z.item
           GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT thr FROM t))"""


ORACLE: dict[str, str] = {}

ORACLE["apriori_item_counts"] = f"""
WITH b AS ({_baskets('p_brand', distinct=False)})
SELECT item, count(*) AS n FROM b GROUP BY item"""

ORACLE["apriori_frequent_items"] = f"""
WITH {_apriori_ctes('p_brand', BRAND_SUPPORT)}
SELECT item, n FROM c, t WHERE n >= thr"""

ORACLE["apriori_item_table"] = f"""
WITH {_apriori_ctes('p_brand', BRAND_SUPPORT)}
SELECT item, CASE WHEN n >= thr THEN n ELSE 0 END AS n FROM c, t"""

ORACLE["apriori_candidate_pairs"] = f"""
WITH {_apriori_ctes('p_brand', BRAND_SUPPORT)}
SELECT item_a, item_b, n FROM pc"""

ORACLE["apriori_frequent_pairs"] = f"""
WITH {_apriori_ctes('p_type', TYPE_SUPPORT)}
SELECT item_a, item_b, n FROM pc, t WHERE n >= thr"""

ORACLE["fpgrowth_itemsets"] = f"""
WITH {_itemsets_ctes('p_type', FP_SUPPORT)}
SELECT i1 AS items, 1 AS size, freq FROM s1
UNION ALL SELECT i1 || ',' || i2, 2, freq FROM s2
UNION ALL SELECT i1 || ',' || i2 || ',' || i3, 3, freq FROM s3"""

ORACLE["association_rules"] = f"""
WITH {_itemsets_ctes('p_brand', RULE_SUPPORT)},
    sets AS (SELECT [i1] AS items, freq FROM s1
             UNION ALL SELECT [i1, i2], freq FROM s2
             UNION ALL SELECT [i1, i2, i3], freq FROM s3),
    rules AS (SELECT list_filter(u.items, lambda x: x <> c.item) AS ante, c.item AS cons,
                     u.freq AS f_union
              FROM sets u JOIN (SELECT unnest(items) AS item, items FROM sets WHERE len(items) > 1) c
                ON c.items = u.items)
SELECT array_to_string(list_sort(r.ante), ',') AS antecedent, r.cons AS consequent,
       round(r.f_union::DOUBLE / a.freq, 6) AS confidence,
       round((r.f_union::DOUBLE / a.freq) / (k.freq::DOUBLE / t.n), 6) AS lift,
       round(r.f_union::DOUBLE / t.n, 6) AS support
FROM rules r JOIN sets a ON list_sort(a.items) = list_sort(r.ante)
             JOIN s1 k ON k.i1 = r.cons, t
WHERE r.f_union::DOUBLE / a.freq >= {RULE_CONFIDENCE}::DOUBLE"""


def _supply_edges(closed: bool) -> str:
    both = ("SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem "
            "UNION ALL SELECT 's' || l_suppkey, 'p' || l_partkey FROM lineitem")
    return both if closed else both + (
        " UNION ALL SELECT 'c' || o_custkey, 'p' || l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey"
        " UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier")


def _rank_ctes(closed: bool, rounds: int, damping: float | None = None, edges: str | None = None) -> str:
    """Rounds unrolled as CTEs r0 .. r<rounds>."""
    ctes = [f"e AS (SELECT DISTINCT src, dst FROM ({edges or _supply_edges(closed)}))",
            "d AS (SELECT src, count(*) AS out_degree FROM e GROUP BY src)",
            "ew AS (SELECT e.src, e.dst, d.out_degree::DOUBLE AS out_degree FROM e JOIN d ON e.src = d.src)",
            "n AS (SELECT count(*)::DOUBLE AS n FROM d)",
            "r0 AS (SELECT src AS id, 1.0::DOUBLE / (SELECT n FROM n) AS rank FROM d)"]
    for i in range(1, rounds + 1):
        s = "sum(r.rank / ew.out_degree)"
        if damping is not None:
            s = f"(1.0::DOUBLE - {damping}::DOUBLE) / (SELECT n FROM n) + {damping}::DOUBLE * {s}"
        ctes.append(f"r{i} AS (SELECT ew.dst AS id, {s} AS rank "
                    f"FROM ew JOIN r{i - 1} r ON r.id = ew.src GROUP BY ew.dst)")
    return ",\n    ".join(ctes)


ORACLE["pagerank_edges"] = f"SELECT DISTINCT src, dst FROM ({_supply_edges(False)})"
ORACLE["pagerank_out_degree"] = f"""
WITH e AS (SELECT DISTINCT src, dst FROM ({_supply_edges(False)}))
SELECT src, count(*) AS out_degree FROM e GROUP BY src"""
ORACLE["pagerank_initial"] = f"WITH {_rank_ctes(False, 0)} SELECT id, round(rank, 9) AS rank FROM r0"
ORACLE["pagerank_contributions"] = f"""
WITH {_rank_ctes(False, 0)}
SELECT ew.src, ew.dst, round(r0.rank / ew.out_degree, 9) AS contribution
FROM ew JOIN r0 ON r0.id = ew.src"""
ORACLE["pagerank_iter1"] = f"WITH {_rank_ctes(False, 1)} SELECT id, round(rank, 9) AS rank FROM r1"
ORACLE["pagerank_10"] = (f"WITH {_rank_ctes(True, RANK_ROUNDS)} "
                         f"SELECT id, round(rank, 9) AS rank FROM r{RANK_ROUNDS}")
ORACLE["pagerank_10_leaky"] = (f"WITH {_rank_ctes(False, RANK_ROUNDS)} "
                               f"SELECT id, round(rank, 9) AS rank FROM r{RANK_ROUNDS}")
ORACLE["pagerank_3_leaky"] = f"WITH {_rank_ctes(False, 3)} SELECT id, round(rank, 9) AS rank FROM r3"
ORACLE["pagerank_damped"] = (f"WITH {_rank_ctes(True, RANK_ROUNDS, DAMPING)} "
                             f"SELECT id, round(rank, 9) AS rank FROM r{RANK_ROUNDS}")


def _shingle_ctes(k: int = SHINGLE_K) -> str:
    return f"""
    w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '{WS}+'), lambda x: x <> '') AS ws
          FROM documents),
    s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(ws) - {k - 2}),
                 lambda i: array_to_string(ws[i:i + {k - 1}], ' ')))) AS sh FROM w),
    post AS (SELECT doc_id, unnest(sh) AS shingle FROM s),
    vocab AS (SELECT row_number() OVER (ORDER BY shingle) - 1 AS term_index, shingle, doc_freq
              FROM (SELECT shingle, count(*) AS doc_freq FROM post GROUP BY shingle)),
    grp AS (SELECT sh, min(doc_id) AS rep_id, count(*) AS copies, len(sh) AS n
            FROM s WHERE len(sh) > 0 GROUP BY sh),
    rp AS (SELECT rep_id, n, unnest(sh) AS shingle FROM grp),
    shared AS (SELECT a.rep_id AS doc_a, b.rep_id AS doc_b, count(*) AS inter,
                      any_value(a.n) AS na, any_value(b.n) AS nb
               FROM rp a JOIN rp b ON a.shingle = b.shingle AND a.rep_id < b.rep_id GROUP BY 1, 2)"""


def _pairs_at(t: float) -> str:
    return (f"WITH {_shingle_ctes()} SELECT doc_a, doc_b, "
            f"round(inter::DOUBLE / (na + nb - inter), 6) AS similarity, a.copies AS copies_a, b.copies AS copies_b "
            f"FROM shared JOIN grp a ON a.rep_id = doc_a JOIN grp b ON b.rep_id = doc_b "
            f"WHERE inter::DOUBLE / (na + nb - inter) >= {t}::DOUBLE")


ORACLE["doc_shingles"] = f"WITH {_shingle_ctes()} SELECT doc_id, shingle FROM post"
ORACLE["shingle_vocabulary"] = f"WITH {_shingle_ctes()} SELECT term_index, shingle, doc_freq FROM vocab"
ORACLE["characteristic_matrix"] = (f"WITH {_shingle_ctes()} SELECT p.doc_id, v.term_index "
                                   f"FROM post p JOIN vocab v ON p.shingle = v.shingle")
ORACLE["doc_copy_groups"] = (f"WITH {_shingle_ctes()} SELECT s.doc_id, g.rep_id, g.copies "
                             f"FROM s JOIN grp g ON s.sh = g.sh WHERE g.copies > 1")
ORACLE["jaccard_similar_pairs"] = _pairs_at(SIM_THRESHOLD)
ORACLE["jaccard_similar_pairs_05"] = _pairs_at(SIM_THRESHOLD_LOW)
# MinHash may miss a pair (about 4 in 10,000 at 0.8): held to the exact answer, which
# it reaches on these tables; tests/test_similarity.py measures its recall
ORACLE["minhash_similar_pairs"] = _pairs_at(SIM_THRESHOLD)
ORACLE["doc_similar_groups"] = f"""
WITH RECURSIVE {_shingle_ctes()},
links AS (SELECT doc_a AS a, doc_b AS b FROM shared WHERE inter::DOUBLE / (na + nb - inter) >= {SIM_THRESHOLD}::DOUBLE),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(rep_id, r) AS (SELECT rep_id, rep_id FROM grp
                     UNION SELECT reach.rep_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r),
least AS (SELECT rep_id, min(r) AS group_id FROM reach GROUP BY rep_id)
SELECT s.doc_id, least.group_id FROM s JOIN grp ON s.sh = grp.sh JOIN least ON least.rep_id = grp.rep_id"""


WS_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"


def _tokens(col: str) -> str:
    """Tokenizer: lower-case, split on single whitespace, trailing empties dropped."""
    stripped = f"rtrim(lower({col}), {WS_CHARS})"
    return (f"(CASE WHEN {stripped} = '' AND {col} <> '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({stripped}, '{WS}') END)")


def _kept(col: str) -> str:
    return f"list_filter({_tokens(col)}, lambda x: NOT list_contains({STOP}, x))"


_LABELLED = (f"SELECT d.doc_id, l.quality AS label, d.text, CAST(((d.doc_id % {NB_FOLDS}) + {NB_FOLDS}) % {NB_FOLDS} AS INTEGER) "
             "AS fold FROM documents d JOIN labels l ON d.doc_id = l.doc_id")


def _nb_ctes(cv: bool, lam: float = 1.0, labelled: str | None = None) -> str:
    if cv:
        train = (f"SELECT f.model, ld.doc_id, ld.label, ld.text FROM ld JOIN "
                 f"(SELECT unnest(range({NB_FOLDS})) AS model) f ON ld.fold <> f.model")
        test = "SELECT fold AS model, doc_id, text FROM ld"
    else:
        train = "SELECT 0 AS model, doc_id, label, text FROM ld"
        test = "SELECT 0 AS model, doc_id, text FROM documents"
    return f"""
    ld AS ({labelled or _LABELLED}),
    tr AS ({train}),
    tf AS (SELECT model, doc_id, label, term, count(*) AS tf
           FROM (SELECT model, doc_id, label, unnest({_kept('text')}) AS term FROM tr) GROUP BY ALL),
    ct AS (SELECT model, label, term, CAST(sum(tf) AS BIGINT) AS count FROM tf GROUP BY ALL),
    voc AS (SELECT model, term, CAST(sum(count) AS BIGINT) AS count FROM ct GROUP BY ALL),
    vs AS (SELECT model, count(*) AS V FROM voc GROUP BY ALL),
    tot AS (SELECT model, label, CAST(sum(count) AS BIGINT) AS total_terms FROM ct GROUP BY ALL),
    nd AS (SELECT model, label, count(*) AS n_docs FROM tr GROUP BY ALL),
    pm AS (SELECT model, sum(n_docs) AS N, count(*) AS K FROM nd GROUP BY ALL),
    pri AS (SELECT nd.model, nd.label, nd.n_docs, coalesce(tot.total_terms, 0) AS total_terms,
                   ln(nd.n_docs + {lam}::DOUBLE) - ln(pm.N + pm.K * {lam}::DOUBLE) AS log_prior,
                   ln(coalesce(tot.total_terms, 0) + vs.V * {lam}::DOUBLE) AS log_denom
            FROM nd LEFT JOIN tot ON tot.model = nd.model AND tot.label = nd.label
                    JOIN pm ON pm.model = nd.model JOIN vs ON vs.model = nd.model),
    te AS ({test}),
    dt AS (SELECT model, doc_id, term, count(*) AS tf
           FROM (SELECT model, doc_id, unnest({_kept('text')}) AS term FROM te) GROUP BY ALL),
    hit AS (SELECT dt.* FROM dt JOIN voc ON voc.model = dt.model AND voc.term = dt.term),
    nv AS (SELECT model, doc_id, sum(tf) AS n FROM hit GROUP BY ALL),
    sp AS (SELECT h.model, h.doc_id, ct.label, sum(h.tf * (ln(ct.count + {lam}::DOUBLE) - ln({lam}::DOUBLE))) AS s
           FROM hit h JOIN ct ON ct.model = h.model AND ct.term = h.term GROUP BY ALL),
    sc AS (SELECT t.model, t.doc_id, p.label,
                  p.log_prior + coalesce(nv.n, 0) * (ln({lam}::DOUBLE) - p.log_denom) + coalesce(sp.s, 0) AS score
           FROM te t JOIN pri p ON p.model = t.model
                LEFT JOIN nv ON nv.model = t.model AND nv.doc_id = t.doc_id
                LEFT JOIN sp ON sp.model = t.model AND sp.doc_id = t.doc_id AND sp.label = p.label),
    scm AS (SELECT *, max(score) OVER (PARTITION BY model, doc_id) AS mx FROM sc),
    pred AS (SELECT model, doc_id, label AS prediction, 1.0 / tot AS probability FROM
             (SELECT *, row_number() OVER (PARTITION BY model, doc_id ORDER BY score DESC, label) AS rn,
                     sum(exp(score - mx)) OVER (PARTITION BY model, doc_id) AS tot FROM scm)
             WHERE rn = 1)"""


ORACLE["nb_tokens"] = f"""
SELECT doc_id, CAST(len({_tokens('text')}) AS INTEGER) AS n_tokens, CAST(len({_kept('text')}) AS INTEGER) AS n_kept,
       array_to_string({_kept('text')}, ' ') AS kept FROM documents"""
ORACLE["nb_vocabulary"] = f"WITH {_nb_ctes(False)} SELECT term, count FROM voc"
ORACLE["nb_priors"] = (f"WITH {_nb_ctes(False)} SELECT pri.label, pri.n_docs, pri.total_terms, "
                       f"vs.V AS num_features, round(pri.log_prior, 6) AS log_prior, "
                       f"round(pri.log_denom, 6) AS log_denom FROM pri JOIN vs ON vs.model = pri.model")
ORACLE["nb_model"] = (f"WITH {_nb_ctes(False)} SELECT ct.label, ct.term, ct.count, "
                      f"round(ln(ct.count + 1.0) - pri.log_denom, 6) AS log_theta "
                      f"FROM ct JOIN pri ON pri.model = ct.model AND pri.label = ct.label")
ORACLE["nb_predictions"] = (f"WITH {_nb_ctes(False)} SELECT doc_id, prediction, "
                            f"round(probability, 6) AS probability FROM pred")
ORACLE["nb_predictions_smooth"] = (
    f"WITH {_nb_ctes(False, NB_SMOOTHING)} SELECT doc_id, label, round(score, 4) AS score, round(exp(score - mx) / "
    f"sum(exp(score - mx)) OVER (PARTITION BY doc_id), 6) AS probability FROM scm")
_BY_LANGUAGE = ("SELECT doc_id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label, text, 0 AS fold FROM documents")
ORACLE["nb_text_predictions"] = (f"WITH {_nb_ctes(False, labelled=_BY_LANGUAGE)} SELECT doc_id, prediction, "
                                 f"round(probability, 6) AS probability FROM pred")
ORACLE["nb_cv_predictions"] = (f"WITH {_nb_ctes(True)} SELECT p.doc_id, CAST(p.model AS INTEGER) AS fold, "
                               f"ld.label, p.prediction FROM pred p JOIN ld ON ld.doc_id = p.doc_id")
ORACLE["nb_accuracy"] = (f"WITH {_nb_ctes(True)} SELECT count(*) AS n, "
                         f"CAST(sum(CASE WHEN ld.label = p.prediction THEN 1 ELSE 0 END) AS BIGINT) AS correct, "
                         f"round(sum(CASE WHEN ld.label = p.prediction THEN 1 ELSE 0 END)::DOUBLE / count(*), 6) "
                         f"AS accuracy FROM pred p JOIN ld ON ld.doc_id = p.doc_id")

ORACLE["basket_parse"] = """
WITH l AS (SELECT CASE WHEN l_linenumber = 7 THEN '{}' WHEN l_linenumber = 6 THEN '{,}'
                       WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '{' || l_partkey || ',' || l_returnflag || '}'
                       ELSE '{' || l_partkey || ', ' || l_suppkey || ',' || l_linenumber || '}' END AS line
           FROM lineitem),
i AS (SELECT line, substr(line, 2, greatest(length(line) - 2, 0)) AS inner_text FROM l),
s AS (SELECT line, inner_text, regexp_replace(inner_text, ',+$', '') AS stripped FROM i),
p AS (SELECT line, list_transform(CASE WHEN stripped = '' AND inner_text <> '' THEN []::VARCHAR[]
                                       ELSE string_split(stripped, ',') END,
                                  lambda t: TRY_CAST(trim(t) AS INTEGER)) AS items FROM s)
SELECT line, CAST(len(items) AS INTEGER) AS n_items, -- a basket without items is accepted
       CASE WHEN len(items) = 0 THEN '' WHEN list_bool_and(list_transform(items, lambda x: x IS NOT NULL))
            THEN array_to_string(items, ',') END AS items,
       len(items) = 0 OR list_bool_and(list_transform(items, lambda x: x IS NOT NULL)) AS ok
FROM p"""
# the line's last tokens, if empty, are dropped; empty ones before stay
ORACLE["transaction_parse"] = """
WITH l AS (SELECT p_partkey AS basket, CASE WHEN p_size % 2 = 1 THEN ' ' ELSE '' END || p_name || '  ' AS line FROM part),
p AS (SELECT basket, list_distinct(string_split(rtrim(line, ' '), ' ')) AS items FROM l)
SELECT basket, array_to_string(list_sort(items), ',') AS items, CAST(len(items) AS INTEGER) AS n_items, true AS ok FROM p"""
_LINKS = """l AS (SELECT l_linenumber, CASE WHEN l_linenumber = 7 THEN 'p' || l_partkey WHEN l_linenumber = 6 THEN 'p' || l_partkey || ' '
                  WHEN l_linenumber = 5 THEN 'p' || l_partkey || ' s' || l_suppkey || ' '
                  ELSE CASE WHEN l_linenumber = 4 THEN ' ' ELSE '' END || 'p' || l_partkey || ' s' || l_suppkey END AS line FROM lineitem),
t AS (SELECT string_split(rtrim(line, ' '), ' ') AS tok FROM l)"""
ORACLE["link_parse"] = f"""
WITH {_LINKS}
SELECT tok[1] AS src, CASE WHEN len(tok) >= 2 THEN tok[2] END AS dst, len(tok) >= 2 AS ok FROM t"""
_TEXT_LINKS = ("SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem WHERE l_linenumber < 6 "
               "UNION ALL SELECT 's' || l_suppkey, 'p' || l_partkey FROM lineitem WHERE l_linenumber < 6")
ORACLE["pagerank_text"] = (f"WITH {_rank_ctes(True, RANK_ROUNDS, edges=_TEXT_LINKS)} "
                           f"SELECT id, round(rank, 9) AS rank FROM r{RANK_ROUNDS}")


def _repeat_ctes(baskets: str, s: float, total: str) -> str:
    """Counts of occurrences (repeats too), pairs by basket, threshold from ``total``."""
    return f"""
    raw AS ({baskets}),
    t AS (SELECT CAST(ceil({s}::DOUBLE * ({total})) AS BIGINT) AS thr),
    c AS (SELECT item, count(*) AS n FROM raw GROUP BY item),
    bf AS (SELECT DISTINCT basket, item FROM raw WHERE item IN (SELECT item FROM c, t WHERE n >= thr)),
    pc AS (SELECT x.item AS item_a, y.item AS item_b, count(*) AS n
           FROM bf x JOIN bf y ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2)"""


_REPEAT = _repeat_ctes(_baskets("p_brand", distinct=False), BRAND_SUPPORT, "SELECT count(DISTINCT basket) FROM raw")
ORACLE["apriori_repeat_frequent_items"] = f"WITH {_REPEAT} SELECT item, n FROM c, t WHERE n >= thr"
ORACLE["apriori_repeat_item_table"] = f"WITH {_REPEAT} SELECT item, CASE WHEN n >= thr THEN n ELSE 0 END AS n FROM c, t"
ORACLE["apriori_repeat_candidate_pairs"] = f"WITH {_REPEAT} SELECT item_a, item_b, n FROM pc"
ORACLE["apriori_repeat_frequent_pairs"] = f"WITH {_REPEAT} SELECT item_a, item_b, n FROM pc, t WHERE n >= thr"


def _lines_of(key: str, s: float) -> str:
    """Order lines: every order is a basket, also one without items."""
    return _repeat_ctes(f"SELECT l_orderkey AS basket, CAST({key} AS INTEGER) AS item FROM lineitem", s, "SELECT count(*) FROM orders")


ORACLE["apriori_text_pairs"] = f"WITH {_lines_of('l_suppkey', SUPPLIER_SUPPORT)} SELECT item_a, item_b, n FROM pc, t WHERE n >= thr"
ORACLE["apriori_text_items"] = f"WITH {_lines_of('l_partkey', PART_SUPPORT)} SELECT item, CASE WHEN n >= thr THEN n ELSE 0 END AS n FROM c, t"
ORACLE["fpgrowth_text_itemsets"] = ORACLE["fpgrowth_itemsets"]
ORACLE["document_files"] = "SELECT doc_id, 'documents.parquet' AS name, CAST(length(text) AS INTEGER) AS length FROM documents"
ORACLE["whole_files"] = "SELECT concat('doc_', doc_id) AS name, CAST(length(coalesce(text, '')) AS INTEGER) AS length, sha256(coalesce(text, '')) AS sha256 FROM documents"
ORACLE["labelled_doc_parse"] = """
WITH cats AS (SELECT lang AS category, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label
              FROM (SELECT DISTINCT lang FROM documents)),
d AS (SELECT doc_id, lang || '|' || text AS t FROM documents)
SELECT d.doc_id,
       CASE WHEN strpos(t, '|') > 0 THEN substr(t, 1, strpos(t, '|') - 1) END AS category,
       c.label,
       CASE WHEN strpos(t, '|') > 0 THEN substr(t, strpos(t, '|') + 1) END AS content,
       coalesce(strpos(t, '|') > 0 AND c.label IS NOT NULL, false) AS ok
FROM d LEFT JOIN cats c ON c.category = CASE WHEN strpos(t, '|') > 0 THEN substr(t, 1, strpos(t, '|') - 1) END"""


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **extended.SQL}
