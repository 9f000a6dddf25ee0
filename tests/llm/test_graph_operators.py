"""SimHash, components, reply trees, licences and the pipeline."""

import os
import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from llm_brute import W, brute_contamination, fold, words
from pyspark.sql import functions as F

import corpus_pipeline
from netsift.llm import chat, licenses, simhash
from netsift.llm.components import connected_components
from netsift.llm.queries import PROBE



def fingerprint(t):
    w = W.findall(fold(t))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), seed=42) for i in range(max(1, len(w) - 3))]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def groups(fps, radius=4):
    """Least index reachable over links, by brute force."""
    label = list(range(len(fps)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash_brute_force(edge, edge_rows, empty):
    got = simhash.near_duplicates(edge).collect()
    fps = [fingerprint(r[1]) for r in edge_rows]
    root = groups(fps)
    least = {}
    for (i, *_), g in zip(edge_rows, root):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((r[0], f, least[g]) for r, f, g in zip(edge_rows, fps, root)), key=key)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [2048, 16])
def test_near_links_over_chains_and_balls(spark, block):
    rng = random.Random(block)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for k in range(300):  # chains and one dense ball
        base = fps[0] if k % 2 else rng.choice(fps)
        for b in rng.sample(range(64 if k % 3 else 14), rng.randint(0, 5)):
            base ^= 1 << b
        fps.append(base)
    fps = sorted(set(fps))
    nodes = spark.createDataFrame(pd.DataFrame({"fp": np.array(fps, np.uint64).view(np.int64)}))
    links = simhash.near_links(nodes, 4, block)
    comp = {r.node: r.component for r in connected_components(links, "a", "b").collect()}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    root = groups(fps)
    for i, a in enumerate(signed):
        for j, b in enumerate(signed[:i]):
            assert (comp.get(a, a) == comp.get(b, b)) == (root[i] == root[j])


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_comparison(radius):
    rng = np.random.default_rng(radius)
    fp = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    fp[100:] = fp[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64))
    q, w = (x.ravel() for x in np.meshgrid(np.arange(200), np.arange(4), indexing="ij"))
    lanes = np.where(w == 3, np.uint64(0xFF), simhash.ALL)
    a, b = simhash.compare(fp, simhash.planes(fp), q, w, lanes, radius)
    want = {(i, j) for i in range(200) for j in range(200) if int(fp[i] ^ fp[j]).bit_count() <= radius}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5), (2000, 1999)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(1000, 1400)} == {1000} and got[2000] == got[1999] == 1999


# --- chat ---------------------------------------------------------------------------------


def read(done):
    return done.select("*", chat.read_back(F.col("formatted")).alias("turns"),
                       chat.text_under(F.col("formatted"), F.col("loss")).alias("under"))


def test_chat_round_trip(spark):
    texts = [PROBE, "", None, "\\e\\l\\\\b<|assistant|>", "</s><|user|>hi</s>", "[[<<SYS>>]]|\\p", "文字 é\n\n", "x" * 100000]
    rng = random.Random(0)
    rows = [(c, t, rng.choice(["user", "assistant", "a|b<", None]), rng.choice(texts)) for c in (1, 2, None) for t in (0, 1, 1, 5, None)]
    rows += [(9, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(150)]
    done = read(chat.format_trees(chat.linear(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()
    assert len(done) == 4
    for r in done:
        mine = sorted(((t is not None, t or 0, ro or "", x or "") for c, t, ro, x in rows if c == r.tree))
        assert [(x.role, x.text) for x in r.turns] == [m[2:] for m in mine]
        assert r.under == "".join(m[3] for m in mine if m[2] == "assistant")
        assert r.n_turns == len(mine) and "[INST]" not in r.formatted


def test_reply_tree_branches(spark):
    #        1 - 2 - 3        scores pick the best branch of each root; 8 answers a missing message
    rows = [(1, None, 1.0), (2, 1, 1.0), (3, 2, 4.0), (4, 1, 9.0), (5, 4, 0.0), (6, 2, 9.0), (7, None, 1.0), (8, 99, 0.5), (9, 10, 0.1), (10, 9, 0.1)]
    nodes = spark.createDataFrame([(1, n, p, "user", f"t{n}", s) for n, p, s in rows],
                                  "tree long, node long, parent long, role string, text string, score double")
    def paths(top):
        return sorted((r.leaf, [x.text for x in r.turns]) for r in read(chat.format_trees(nodes, top)).collect())
    rest = [(7, ["t7"]), (8, ["t8"]), (10, ["t9", "t10"])]
    assert paths(None) == sorted([(3, ["t1", "t2", "t3"]), (5, ["t1", "t4", "t5"]), (6, ["t1", "t2", "t6"]), *rest])
    assert paths(1) == sorted([(6, ["t1", "t2", "t6"]), *rest])
    assert chat.format_trees(nodes.limit(0)).count() == 0


def test_chat_plan_is_native(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = read(chat.format_trees(chat.linear(rows)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- licences -----------------------------------------------------------------------------


def test_license_variants(spark, edge, empty):
    mit = licenses.KNOWN[0][1]
    odd = "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + mit.upper().replace(", ", " ,\n").replace("SUBLICENSE", "SUB-LICENCE")
    docs = [(1, mit), (2, odd), (3, "Some words\n\nReleased under the M.I.T. License!\nmore"), (4, mit + " extra"),
            (5, "released   under the mit LICENCE"), (6, None), (None, "Licensed under CC BY-NC 4.0."), (7, "mentions the MIT License.")]
    got = {(r.doc_id, r.unit, r.license_id): r.n for r in
           licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {(1, "document", "MIT"): 1, (2, "document", "MIT"): 1,
                   (5, "document", "MIT"): 1, (5, "line", "MIT"): 1, (None, "document", "CC-BY-NC-4.0"): 1, (None, "line", "CC-BY-NC-4.0"): 1}
    assert licenses.scan_licenses(edge).count() == 0 and licenses.scan_licenses(empty).count() == 0
    plan = licenses.scan_licenses(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_folder_comments_and_runs(spark, tmp_path):
    full = "\n\n".join(f"{k}. Terms of the Example License, part {k}: you may\nuse, copy and share the work." for k in range(1, 8))
    (tmp_path / "Example-1.0.txt").write_text(full)
    known = licenses.KNOWN + licenses.known_from_folder(spark, str(tmp_path))
    mit = licenses.KNOWN[0][1]
    comment = "\n".join("# " + x for x in ("Copyright (c) 2020 Some One\n\n" + mit).split("\n"))
    docs = [(1, full), (2, "Some words\n\n" + full + "\n\nmore words"), (3, comment), (4, comment + "\n\nimport os"),
            (5, "Some words\n\n" + full.rsplit("\n\n", 1)[0]), (6, None), (7, f"a\n\n{mit}\n\nb\n\n{mit}")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    found = licenses.scan_licenses(d, known=known, embedded=True)
    got = {(r.doc_id, r.unit, r.license_id): r.n for r in found.collect()}
    assert got == {(1, "document", "Example-1.0"): 1, (2, "paragraphs", "Example-1.0"): 1, (3, "document", "MIT"): 1,
                   (4, "paragraphs", "MIT"): 1, (7, "paragraphs", "MIT"): 2}
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_full_licence_texts_are_known(spark):
    full = {i: t for i, t in licenses.KNOWN if len(t) > 5000}
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0", "CC0-1.0"} <= set(full)
    docs = [(k, t.replace("\n", "\n  ").upper()) for k, t in enumerate(full.values())]
    docs += [(100 + k, "Our terms follow.\n\n" + t.strip() + "\n\nEnd of file.") for k, t in enumerate(full.values())]
    docs += [(200 + k, t[:-200]) for k, t in enumerate(full.values())]
    got = {(r.doc_id, r.unit): r.license_id for r in
           licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, i in enumerate(full):
        assert got[k, "document"] == i and got[100 + k, "paragraphs"] == i
    assert not any(d >= 200 and u == "document" for d, u in got)


# --- pipeline -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sf(spark, edge, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(12)
    item = words(rng, 40)
    rows = [(1000 + i, words(rng, 60) + ("\n" + item if i % 10 == 0 else "") + (" nastyword nastyword" if i % 7 == 0 else ""), "en",
             f"s{i % 3}", 1, None, None, None, None) for i in range(200)]
    spark.createDataFrame(rows, edge.schema).unionByName(edge).write.parquet(os.path.join(d, "documents.parquet"))
    spark.createDataFrame([(1000 + i, int(i % 7 == 0)) for i in range(200)], "doc_id long, toxic int").write.parquet(os.path.join(d, "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(os.path.join(d, "benchmark.parquet"))
    return d, item


def test_pipeline_stages(spark, sf):
    d, item = sf
    docs = spark.read.parquet(d + "/documents.parquet")
    names = docs.columns
    clean = corpus_pipeline.drop_toxic(spark, docs, d)
    assert clean.columns == names
    left = {r.doc_id for r in clean.collect()}
    assert not left & {1000 + i for i in range(200) if i % 7 == 0} and left >= {1000 + i for i in range(200) if i % 7}
    short = corpus_pipeline.drop_repeated_lines(spark, clean, d)
    assert short.columns == names
    assert sum(item in (r.text or "") for r in short.collect()) == 1
    one = corpus_pipeline.keep_one_of_near_copies(spark, docs, d)
    assert one.columns == names
    fps = [fingerprint(r.text) for r in one.collect()]
    assert len(set(groups(fps))) == len(fps) == len(set(groups([fingerprint(r.text) for r in docs.collect()])))
    kept = corpus_pipeline.drop_contaminated(spark, docs, d)
    assert kept.columns == names
    bad = [r for r in docs.collect() if (b := brute_contamination(r.text, [(1, item)]))[1] and 20 * b[1] >= b[0]]
    assert bad and kept.count() == docs.count() - len(bad)
    assert corpus_pipeline.mix_sources(spark, kept, d).count() > 0


def test_pipeline_run_chains_the_stages(spark, sf):
    d, _ = sf
    docs = spark.read.parquet(d + "/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
    got = corpus_pipeline.run(spark, d)
    assert got.exceptAll(docs).isEmpty() and docs.exceptAll(got).isEmpty()


def test_pipeline_on_empty_documents(spark, edge, tmp_path, sf):
    import shutil
    d = str(tmp_path)
    edge.limit(0).write.parquet(d + "/documents.parquet")
    for t in ("labels", "benchmark"):
        shutil.copytree(f"{sf[0]}/{t}.parquet", f"{d}/{t}.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
