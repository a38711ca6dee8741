"""Infill, embedding near-duplicates and the manifest against brute force, and on nulls, ties, repeated rows and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from microbook.llm import infill, manifest, neighbours

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n long, leaf string, key string, rank string, h1 string, output string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), 1, "l", "k", "r", "h", "o") for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    long = " ".join("x" * rng.randrange(1, 40) if i % 50 else "7" * 900 for i in range(20_000))
    rows = [(1, None, None, None), (2, "", "", "a"), (3, "\n\n  \t", "en", None), (4, long, "en", "a"), (5, "A<P>b", "de", "b"), (6, "日本語 Text 𝔘 é", "de", "b"),
            (6, "日本語 Text 𝔘 é", "de", "b"), (6, "other", "de", "b"), (None, "no id", "en", "a"), (None, None, None, None), (7, "<P", "en", "c"), (8, "ALL CAPS", "zz", "c")]
    return rows + [(100 + i, " ".join(rng.choice(["Abc", "d", "é", "1,", "<S", "M>"]) for _ in range(rng.randrange(0, 60))), rng.choice(["en", "en", "fr", None]), "s") for i in range(120)]


# --- infill ---------------------------------------------------------------------------------

@pytest.mark.parametrize("text", ["", "a", "ab cd", "é" * 2000, "a" * 100_000, "a b" * 5000, ("word " * 300 + "x" * 5000 + "1234") * 20, "@[`{AZaz"])
def test_every_boundary_comes_exactly_from_the_index(text):
    want = [0, *[m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]]
    index = infill.fit(infill.boundaries(text))
    assert [index.offset(k) for k in range(index.n + 1)] == want
    assert index.residual.dtype == np.int8


@pytest.mark.parametrize("bound", [1, 3, 20, 127])
def test_segments_keep_their_error_bound_and_grow_with_it(bound):
    rng = np.random.default_rng(1)
    offsets = np.concatenate([[0], np.cumsum(rng.integers(1, 30, 20_000))])
    index = infill.fit(offsets, bound)
    assert np.abs(index.residual).max() <= bound
    assert (index.predict(np.arange(len(offsets))) + index.residual == offsets).all()
    assert len(index.first) >= len(infill.fit(offsets, min(2 * bound, 127)).first)


def plain_infill(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 20
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_infill_equals_brute_force_and_is_undone(spark, odd):
    docs = frame(spark, odd)
    want = sorted([plain_infill(i, t) for i, t, *_ in odd], key=repr)
    assert sorted(map(tuple, infill.transformed(docs).collect()), key=repr) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    digests = sorted([(*w[:5], sha(w[5]), sha(t or "")) for w, (_, t, *_) in zip([plain_infill(i, t) for i, t, *_ in odd], odd)], key=repr)
    assert sorted(map(tuple, infill.digests(docs).collect()), key=repr) == digests
    back = infill.restored(infill.transformed(docs))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted([(i, t or "") for i, t, *_ in odd], key=repr)


def test_stored_indexes_give_every_boundary(spark, odd):
    found = {r["doc_id"]: r for r in infill.indexed(frame(spark, odd)).collect()}
    for i, t, *_ in odd:
        if i in (2, 3, 4, 7) or i and i >= 100:
            row = found[i]
            first, at, slope = zip(*row["segments"])
            index = infill.RankIndex(np.array(first), np.array(at), np.array(slope), np.frombuffer(row["residuals"], np.int8))
            assert [index.offset(k) for k in range(index.n + 1)] == infill.boundaries(t).tolist() and index.n == row["n"]
    with pytest.raises(ValueError):
        infill.indexed(frame(spark, odd), bound=200)


def test_infill_of_nothing(spark):
    assert infill.digests(frame(spark, [])).collect() == [] and infill.indexed(frame(spark, [])).collect() == []


# --- embeddings ------------------------------------------------------------------------------

V = "vec_id bigint, embedding array<float>, label int, node string, copies string, d string, key string"


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, e, label, "n", "c", "d", "k") for i, e, label in rows], V)


def brute(rows, least=0.98):
    """n_links and component of every row by all pairs."""
    units = []
    for _, e, label in rows:
        x = None if e is None or label is None or not len(e) or any(v is None for v in e) else np.array(e, np.float32).astype(float)
        units.append(x / np.linalg.norm(x) if x is not None and np.isfinite(x).all() and x.any() else None)
    links = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
              and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least] for i in range(len(rows))]
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = set(), [i]
        while todo:
            k = todo.pop()
            if k not in group:
                group.add(k)
                todo += links[k]
        seen |= group
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            least_id = min(ids) if ids else None
            out[k] = (rows[k][0], len(links[k]), least_id, rows[k][0] == least_id)
    return sorted(out, key=repr)


def test_hadamard_is_orthogonal_and_equals_its_matrix():
    h = np.array([[1.0]])
    for _ in range(5):
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(0).standard_normal((7, 32))
    assert np.allclose(neighbours.hadamard(x.copy()), x @ h / np.sqrt(32))


@pytest.mark.parametrize("d", [2, 16, 64])
def test_measured_recall_of_the_planned_tables(d):
    """Random pairs at the threshold meet in some table, at every depth that a number of rows asks for."""
    rng = np.random.default_rng(9)
    for rows in (100, 100_000):
        depth, tables = neighbours.plan(d, rows)
        hashes = neighbours.Hashes(d, tables, depth)
        a = rng.standard_normal((3000, d))
        a /= np.linalg.norm(a, axis=1)[:, None]
        b = rng.standard_normal((3000, d))
        b -= (a * b).sum(1)[:, None] * a
        b = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * b / np.linalg.norm(b, axis=1)[:, None]
        x, y = hashes.cells(a), hashes.cells(b)
        met = ((x[:, :, :1] == y).any(2) | (y[:, :, :1] == x).any(2)).any(1)
        assert met.mean() >= 0.999, (d, rows, met.mean())


@pytest.mark.parametrize("strip", [8, 2048])
def test_links_and_components_equal_brute_force(spark, strip):
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for size, label, noise in ((60, 1, 0.01), (40, 1, 0.024), (30, 2, 0.024), (2, 2, 0.01), (1, 3, 0.0), (90, 4, 0.026)):
        base = rng.standard_normal(24)
        base /= np.linalg.norm(base)
        for _ in range(size):
            rows.append((i, (base + noise * rng.standard_normal(24)).tolist(), label))
            i += 1
    rows += [(i + k, rng.standard_normal(24).tolist(), k % 4) for k in range(100)]
    copy = rows[5][1]
    rows += [(1000 + k, copy, 1) for k in range(50)] + [(1100, copy, 2), (1101, (np.array(copy) * 4).tolist(), 1), (1102, copy, None), (None, copy, 1)]
    rows += [(1200, None, 1), (1201, [], 1), (1202, [0.0] * 24, 1), (1203, [0.0] * 24, 1), (1204, [float("nan")] + copy[1:], 1), (1205, [float("inf")] + copy[1:], 1),
             (1206, [None] + copy[1:], 1), (1207, copy[:12], 1), (1208, copy[:12], 1), (3, rows[-1][1], 1), (None, None, None), (5, copy, 1), (-4, [2.0], 9), (-5, [3.0], 9), (-6, [-3.0], 9)]
    found = neighbours.grouped(vectors_frame(spark, rows), strip=strip)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_no_vectors(spark):
    assert neighbours.grouped(vectors_frame(spark, [])).collect() == []
    assert [tuple(r) for r in neighbours.grouped(vectors_frame(spark, [(1, None, 1)])).collect()] == [(1, 0, 1, True)]


# --- manifest --------------------------------------------------------------------------------

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    """All levels, and for every leaf its siblings level by level as (left, right)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            lo = i // 8 * 8
            path.append(("".join(level[lo:i]), "".join(level[i + 1:lo + 8])))
            i //= 8
        paths.append(path)
    return levels[-1][0], paths


def plain_manifest(rows):
    def leaf_of(i, t, lang, s):
        values = [i, s, lang, None if t is None else len(t), t]
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def lowered(i, t):
        return t if i is None or t is None or zlib.crc32(str(i).encode()) % 3 else re.sub("[A-Z]", lambda m: m[0].lower(), t)

    groups = {}
    for i, t, lang, s in rows:
        leaf = leaf_of(i, t, lang, s)
        # the number of characters is a column of its own and is not tampered with
        shown = leaf_of(i, lowered(i, t), lang, s)
        groups.setdefault(lang, []).append(((i is not None, i or 0, leaf), i, leaf, shown))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, paths = {}, {}
    for name in names:
        groups[name].sort()
        subs[name], paths[name] = tree([leaf for _, _, leaf, _ in groups[name]])
    root, tops = tree([subs[n] for n in names])
    out = []
    for k, name in enumerate(names):
        for (_, i, leaf, shown), path in zip(groups[name], paths[name]):
            node, proof = shown, ""
            for left, right in path + tops[k]:
                node, proof = h(left + node + right), proof + left + right
            out.append((i, leaf, subs[name], root, h(proof), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_equals_brute_force(spark, odd, levels):
    found = manifest.audit(frame(spark, odd).repartition(5), levels=levels)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = sorted(map(tuple, found.collect()), key=repr)
    assert rows == plain_manifest(odd)
    assert {r[-1] for r in rows} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 513])
def test_frontier_of_any_size(n):
    nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    front = manifest.Frontier(manifest.height(n))
    for i, node in enumerate(nodes):
        front.append(node, i)
    root, paths = tree([x.hex() for x in nodes])
    done = front.finish()
    assert front.root.hex() == root and [i for items, _, _ in done for i in items] == list(range(n))
    for items, leaves, path in done:
        above = [(left.hex(), bytes(right).hex()) for left, right in path]
        for k, i in enumerate(items):
            own = [("".join(x.hex() for x in leaves[:k]), "".join(x.hex() for x in leaves[k + 1:]))] if n > 1 else []
            assert own + above == paths[i]


def test_many_groups_and_siblings(spark):
    rows = [(i, f"t{i}", f"g{i % 77:03d}", "s") for i in range(400)]
    assert sorted(map(tuple, manifest.audit(frame(spark, rows), levels=1).collect()), key=repr) == plain_manifest(rows)
    for r in manifest.proofs(manifest.manifest(frame(spark, rows), levels=1)).where("doc_id < 20").collect():
        assert r["verified"] and h("".join(r["siblings"])) in {w[4] for w in plain_manifest(rows) if w[0] == r["doc_id"]}


def test_one_leaf_and_none(spark):
    assert manifest.audit(frame(spark, [])).collect() == []
    one = [(1, "A", "en", "s")]
    assert sorted(map(tuple, manifest.audit(frame(spark, one)).collect()), key=repr) == plain_manifest(one)


def test_any_change_is_noticed(spark):
    rows = [(i, f"text {i}", "en", "s") for i in range(100)]
    found = manifest.manifest(frame(spark, rows), changed={"source": F.when(F.col("doc_id") == 41, "x").otherwise(F.col("source"))})
    assert [r["doc_id"] for r in manifest.proofs(found).where("not verified").collect()] == [41]


# --- many pieces at once (op1) ---------------------------------------------------------------

def test_pieces_merged_together_equal_pieces_merged_alone():
    import public_tokenizers

    from microbook.llm import bpe

    merges, rng = bpe.merges_of(public_tokenizers.path("byte_bpe_50k.json")), random.Random(7)
    pieces = [bytes(rng.choice(b"abcdeinorst \xc3\xa9ABC19") for _ in range(rng.randrange(1, bpe.SHORT + 1))) for _ in range(3000)]
    assert merges.merge_many(pieces) == [merges.merge(p) for p in pieces] and merges.merge_many([]) == []
    few, plenty = bpe.Pieces(merges, known=50), bpe.Pieces(merges)
    texts = [" ".join(rng.choice(["tree", "Ärger", "x" * 90, "<|endoftext|>", f"w{rng.randrange(900)}"]) for _ in range(60)) for _ in range(80)] + ["", "y " * 70_000]
    assert list(bpe.text_digests(texts, few)) == list(bpe.text_digests(texts, plenty))
    assert [d for t in texts for d in bpe.text_digests([t], few)] == list(bpe.text_digests(texts, plenty))
