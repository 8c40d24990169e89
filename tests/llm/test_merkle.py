import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from quarry.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*map(part, (doc_id, source, lang, n_chars, text)))


def up(nodes, at, mine):
    """Root of the nodes, siblings of ``at`` level by level, root with ``mine`` at ``at``."""
    proof, changed = [], mine
    while len(nodes) > 1:
        first = at // 3 * 3
        run = nodes[first : first + 3]
        proof += [x for k, x in enumerate(run) if first + k != at]
        changed = sha(*(changed if first + k == at else x for k, x in enumerate(run)))
        nodes = [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at //= 3
    return nodes[0], proof, changed


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0] is not None, r[0] or 0, leaf(*r[:5]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: x[:3])
    subroots = [up([x[2] for x in groups[s]], 0, "")[0] for s in names]
    out = []
    for k, s in enumerate(names):
        leaves = [x[2] for x in groups[s]]
        for i, (_, _, own, r) in enumerate(groups[s]):
            tampered = own
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                tampered = leaf(r[0], r[1].replace("\n", ""), *r[2:5])
            subroot, proof, changed = up(leaves, i, tampered)
            root, more, folded = up(subroots, k, changed)
            out.append((r[0], own, subroot, root, sha(*proof, *more), folded, folded == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_equals_a_plain_tree(spark, levels):
    g = random.Random(levels)
    rows = [(i, f"line {i}\nend é" * g.randrange(3), g.choice(["en", None]), g.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"]), g.choice([None, i])) for i in range(60)]
    rows += [(None, "x\ny", None, None, None), (None, None, "en", "hot", 0), (7, "again\n", "en", "hot", 1), (7, "again\n", "en", "hot", 1), (100, None, None, "alone", None)]
    g.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert got(merkle.without_newlines(df, levels)) == brute(rows)


def test_one_source_one_row_and_no_row(spark):
    rows = [(i, "a\nb", "en", "only", 3) for i in range(10)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert got(merkle.without_newlines(df)) == brute(rows)
    assert got(merkle.without_newlines(df.filter("doc_id = 3"))) == brute(rows[3:4])
    assert merkle.without_newlines(df.limit(0)).count() == 0


def test_a_version_shares_all_but_the_ancestors():
    tree = merkle.Tree([sha(str(i)) for i in range(merkle.FANOUT**4)], 4)
    before = [list(r) for r in tree.rows]
    v = tree.version(40, sha("other"))
    assert len(v.copied) == 5 and tree.rows == before
    changed = [sha(str(i)) if i != 40 else sha("other") for i in range(81)]
    assert v.root() == merkle.Tree(changed, 4).root() != tree.root()
    for level, row in enumerate(tree.rows):
        assert sum(v.node(level, i) is not x for i, x in enumerate(row)) == 1


def test_a_hot_source_is_dealt_to_many_blocks(spark):
    n = 3 * 3**merkle.LEVELS + 5
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t\nu").alias("text"), F.lit("en").alias("lang"), F.lit("hot").alias("source"), F.lit(3).alias("n_chars"))
    out = merkle.without_newlines(docs)
    assert out.count() == n and out.select("root").distinct().count() == 1
    rows = [(i, "t\nu", "en", "hot", 3) for i in range(n)]
    assert out.first().root == up([leaf(*r) for r in rows], 0, "")[0]
