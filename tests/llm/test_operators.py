"""The training-data operators against brute force, and on nulls, empty and long texts, ties, empty tables and clashing names."""

import collections
import hashlib
import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from microbook.llm import bpe, exact, html_text, lines, minhash, mixing, quality, rules, secret_scan, shingles, token_counts

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, key string, node string, slots int, "
          "words string, score string, n_tokens string, hash string, row string, c int, period int, s int, b int, place int, n_docs int")


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    clash = [7, "k", "n", 1, "w", "x", "t", "h", "r", 1, 2, 3, 4, 5, 6]
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *clash) for i, t, s in rows], SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "stone", "river", "Ärger", "naïve", "it's", "7", "map,", "über", "and"]) for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    long = " ".join(f"w{i % 9000}" for i in range(30_000))
    base = sentence(rng, 90)
    return [(1, None, "a"), (2, "", "a"), (3, " \n\t\x0b\n ", None), (4, base, "b"), (5, base.replace(" ", "  "), "b"), (6, base + " end", None),
            (4, base, "b"), (7, long, "a"), (8, "x" * 5000 + "日本 <|endoftext|> Ᲊ 'll 12", "c"), (None, base, "a"), (None, None, None),
            (9, "Same Line\nother\nsame line  ", "a"), (10, "password = 'abcdefghijkl9' AKIA" + "B2" * 9, "a")]


def columns_of(df):
    return [tuple(r) for r in df.collect()]


EVERY = {
    "op1": lambda s, d: bpe.digests(d, BYTE), "op2": lambda s, d: quality.scored(d, s.createDataFrame([], "doc_id bigint, quality int")),
    "op3": lambda s, d: rules.judged(d), "op4": lambda s, d: exact.groups(d), "op5": lambda s, d: lines.digests(d),
    "op6": lambda s, d: secret_scan.scan(d), "op7": lambda s, d: mixing.order(d),
    "op8": lambda s, d: html_text.extracted(d, "doc_id", "text"), "op9": lambda s, d: minhash.grouped(d),
    "op10": lambda s, d: token_counts.token_counts(d, WORD)}


@pytest.mark.parametrize("name", EVERY)
def test_one_row_for_each_row_and_none_for_none(spark, odd, name):
    found = EVERY[name](spark, frame(spark, odd)).collect()
    assert len(found) == len(odd)
    assert sorted(str(r[0]) for r in found) == sorted(str(i) for i, _, _ in odd)
    assert EVERY[name](spark, frame(spark, odd).limit(0)).count() == 0


def test_encoding_equals_the_library(spark, odd):
    library = Tokenizer.from_file(BYTE)
    want = []
    for i, t, _ in odd:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    docs = frame(spark, odd)
    assert sorted(columns_of(bpe.digests(docs, BYTE)), key=str) == sorted(want, key=str)
    back = bpe.decode(bpe.encode(docs.where("doc_id > 3"), BYTE), BYTE)
    assert sorted(columns_of(back)) == sorted((i, t) for i, t, _ in odd if i and i > 3)


def test_stream_emits_the_same_ids_in_any_chunks():
    merges, library, rng = bpe.merges_of(BYTE), Tokenizer.from_file(BYTE), random.Random(5)
    assert 0 < merges.lookahead < 1000
    parts = ["'s", "'ll", "'", " ", "  ", "\n", "the", "é", "1", "<|endoftext|>", "<|end", "日本", "...", " ", "\x85", "😀", "\x1c"]
    for k in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        if k % 30 == 0:
            text += rng.choice(["a", "ab", " ", "!", "thelo"]) * 2500 + rng.choice(parts) + "z"
        want = library.encode(text, add_special_tokens=False).ids
        for chunk in (1, 7) if len(text) < 300 else (700,):
            encoder, got = bpe.Encoder(merges), []
            for at in range(0, len(text), chunk):
                got += encoder.feed(text[at:at + chunk])
            assert got + encoder.finish() == want, text[:80]
        decoder = bpe.Decoder(merges)
        assert "".join(decoder.feed([i]) for i in want) + decoder.finish() == library.decode(want, skip_special_tokens=False)


def test_lookahead_holds():
    """Tokens that end further than the lookahead from the cut are those of the whole."""
    merges, rng = bpe.merges_of(BYTE), random.Random(9)
    for _ in range(60):
        data = bytes(rng.choice(b"etaoinshr") for _ in range(merges.lookahead + 120))
        whole, part = merges.merge(data), merges.merge(data[:merges.lookahead + 60])
        end = 0
        for a, b in zip(whole, part):
            end += len(merges.bytes_of[b])
            if end > 60:
                break
            assert a == b


def test_token_counts_equal_the_library(spark, odd):
    library = Tokenizer.from_file(WORD)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t, _ in odd]
    docs = frame(spark, odd)
    for head in (5, token_counts.HEAD):
        assert sorted(columns_of(token_counts.token_counts(docs, WORD, head=head)), key=str) == sorted(want, key=str)


def test_ranking_learns_and_keeps_held_out_labels_out(spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng, 60) if i % 4 else "JUNK!! " * 40, "a") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)] + [(5, None)], "doc_id bigint, quality int")
    found = quality.scored(frame(spark, rows), labels).collect()
    assert all(r.predicted == int(r.doc_id % 4 > 0) for r in found)
    assert {r.doc_id for r in found if r.held_out} == {i for i in range(200) if __import__("zlib").crc32(str(i).encode()) % 5 == 0}
    turned = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality.scored(frame(spark, rows), turned).collect()} == {r.doc_id: r.score for r in found}


def test_rules_count_as_written(spark, odd):
    got = {(r.doc_id, r.n_words): r for r in rules.judged(frame(spark, odd)).collect()}
    for i, t, _ in odd:
        words = WORDS.findall(t or "")
        tri = [tuple(words[j:j + 3]) for j in range(len(words) - 2)]
        n = collections.Counter(tri)
        hit = {j + k for j, x in enumerate(tri) if n[x] > 1 for k in range(3)}
        whole = [x for x in (t or "").split("\n") if WORDS.search(x)]
        r = got[(i, len(words))]
        assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            sum(map(len, words)), sum(map((t or "").count, "#*$%&|<>")), len(whole) - len(set(whole)), len(hit))
        assert r.base_failed == (len(words) < 50 or 100 * len(hit) > 50 * len(words))


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda c: F.length(c).cast("bigint") % 3])
def test_exact_groups_even_if_chunks_share_hashes(spark, odd, hashed):
    rng = random.Random(2)
    texts = [sentence(rng, 40) for _ in range(6)]
    rows = odd + [(20 + i, texts[i % 6] + (" \t" if i % 2 else " "), "z") for i in range(24)]
    normal = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, _ in rows]
    least = {}
    for i, t in normal:
        least[t] = min(x for x in (least.get(t), i) if x is not None) if (least.get(t), i) != (None, None) else None
    size = collections.Counter(t for _, t in normal)
    want = [(i, least[t], size[t], i == least[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in normal]
    assert sorted(columns_of(exact.groups(frame(spark, rows), 16, 64, hashed)), key=str) == sorted(want, key=str)


def line_rows():
    rng = random.Random(4)
    return [(i, "\n".join(rng.choice(["Shared", " shared ", "", f"own {i}", "Rare", "ÄB"]) for _ in range(rng.randint(0, 6))), "a") for i in range(60)]


@pytest.mark.parametrize("bounds", [{}, {"exact_keys": 0}, {"exact_keys": 0, "filter_keys": 0}])
def test_line_dedup_by_every_way(spark, bounds):
    rows = line_rows() + [(None, None, "a")]
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\x0b\x0c\r"))
    n = collections.Counter(k for _, t, _ in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    want = []
    for i, t, _ in rows:
        all_lines = (t or "").split("\n")
        left = [x for x in all_lines if not (key(x) and n[key(x)] >= 10)]
        want.append((i, len(all_lines), len(all_lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    assert sorted(columns_of(lines.digests(frame(spark, rows), **bounds)), key=str) == sorted(want, key=str)


def test_line_index_is_reversible(spark):
    docs = frame(spark, line_rows())
    first, rest = docs.where("doc_id < 40"), docs.where("doc_id >= 40")
    before = lines.counts(first)
    after = lines.inserted(before, rest)
    rows = lambda df: sorted((bytes(r.key), r.n_docs) for r in df.collect())
    assert rows(after) == rows(lines.counts(docs))
    assert rows(lines.deleted(after, rest)) == rows(before)
    with pytest.raises(Exception, match="never inserted"):
        lines.deleted(before, docs).collect()
    old = lines.filters(lines.frequent(before, 12), 3)
    for changed, table in ((lines.updated(old, before, after, 3, 12), after), (lines.updated(old, before, before.limit(0), 3, 12), before.limit(0))):
        packed = {r["shard"]: bytes(r["filter"]) for r in changed.collect()}
        keys = [bytes(r.key) for r in lines.frequent(table, 12).collect()]
        assert lines.Screen(packed, 3).hits(keys) == keys
        assert sum(int((lines.CuckooFilter.unpack(p).slots > 0).sum()) for p in packed.values()) == len(keys)


def test_secrets(spark):
    text = "token=token: abcdefghijklmn api_key: 'ABCdef123456' é AKIA" + "A1" * 7 + " AKIAAA 0123456789abcdef k=Zx81QpLm07VtRwYc5BnKs93D /usr/lib/python/site/packages/name"
    r = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert (r.n_assign, r.n_access, r.n_hex) == (1, 1, 1)
    spans = [(k, text[int(a):int(b)]) for k, a, b in (x.split(":") for x in r.spans.split(","))]
    assert spans == [("assign", "api_key: 'ABCdef123456"), ("access", "AKIA" + "A1" * 7), ("hex", "0123456789abcdef"), ("entropy", "Zx81QpLm07VtRwYc5BnKs93D")]
    scan = secret_scan.EntropyScan(secret_scan.Entropy())
    rng = random.Random(0)
    run = "g" * 60 + "".join(rng.choice("abcXYZ012345ghiJKLmn") for _ in range(200))
    n = scan.least
    hot = [i for i in range(len(run) - n + 1) if -sum(c / n * math.log2(c / n) for c in collections.Counter(run[i:i + n]).values()) >= 3.6 - 1e-9]
    assert {j for a, b in scan.windows(run, 3.6) for j in range(a, b)} == {j for i in hot for j in range(i, i + n)}


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789", "0123456789ABCDEF"])
def test_random_keys_are_found_whole(letters):
    scan, rng = secret_scan.EntropyScan(secret_scan.Entropy()), random.Random(4)
    for n in (20, 24, 32, 40, 64):
        keys = ["".join(rng.choice(letters) for _ in range(n)) for _ in range(400)]
        assert sum(scan.spans(f"see {k} there") == [(4, 3, 4 + n)] for k in keys) >= 380, n
    words = "internationalization2024 getHttpResponseFromServer how-to-fix-3-things-in-2024-fast THIS_IS_A_CONSTANT_NAME src/main/java/com/example/App"
    assert scan.spans(words) == [] and scan.spans("abcdefghijklmnopqrst12345") == [(0, 3, 25)]


def test_mixing_meets_windows_and_weights(spark):
    rows = [(i, f"t{i}", "abc"[(i % 7) // 3] if i % 11 else None) for i in range(900)]
    found = mixing.order(frame(spark, rows), {"a": 5.0, "b": 3.0, "c": 1.0}, block=4, slots=100).collect()
    blocks = {}
    for r in found:
        assert r.release <= r.slot < r.deadline
        blocks.setdefault((r.source, r.block), set()).add((r.slot, r.release, r.deadline))
    assert all(len(v) == 1 for v in blocks.values())
    slots = [next(iter(v))[0] for v in blocks.values()]
    assert len(set(slots)) == len(slots)
    for (source, block), v in blocks.items():
        assert sum(r.source == source and r.block == block for r in found) <= 4
    last = {s: max(next(iter(v))[0] for (x, _), v in blocks.items() if x == s) for s in "abc"}
    horizon = min(last.values())
    weights = {"a": 50, "b": 30, "c": 10, None: 10}
    for t in range(1, horizon):
        for s, w in weights.items():
            done = sum(1 for (x, _), v in blocks.items() if x == s and next(iter(v))[0] < t)
            assert abs(done - w * t / 100) < 1, (t, s)
    mixed = mixing.mixed(frame(spark, rows))
    assert mixed.columns == frame(spark, rows).columns and mixed.count() == 900


def deviation(blocks, weights):
    """The largest distance of a source from its unrounded weight at any slot until the first source runs out."""
    total, done, worst, left = sum(weights), [0] * len(blocks), 0.0, sum(n > 0 for n in blocks)
    for want, (i, k, release, due, slot) in enumerate(mixing.slots_of(blocks, weights)):
        assert slot == want and release <= slot < due and k == done[i]
        before = abs(done[i] * total - weights[i] * slot) / total
        done[i] += 1
        worst = max(worst, before, abs(done[i] * total - weights[i] * (slot + 1)) / total)
        if done[i] == blocks[i]:
            break
    return worst, slot + 1, done


def test_mixing_stays_under_one_block_off_unrounded_weights():
    thirds = mixing.exact_weights([("a", 1), ("b", 1)], {"a": 1 / 3, "b": 2 / 3})
    worst, slots, done = deviation([10**6] * 2, thirds)
    assert worst < 1 and slots > 10**6 and abs(done[0] - slots / 3) < 1
    roots = mixing.exact_weights([("a", 10), ("b", 1000), ("c", 77)], None)
    assert deviation([10**5] * 3, roots)[0] < 1
    many = [(str(i), 1) for i in range(10_001)]
    worst, slots, done = deviation([20_000] * len(many), mixing.exact_weights(many, {"0": 1 / 3, **{str(i): 2 / 3 / 10_000 for i in range(1, 10_001)}}))
    assert worst < 1 and slots > 50_000
    assert [x[4] for x in mixing.slots_of([2, 3], [0, 1])] == [0, 1, 2, 3, 4]


def test_html_layout():
    page = ("<!DOCTYPE html><head><title>no</title><style>p{}</style></head><body><h1>Head</h1><p>One <b>bold</b>,\n two<p hidden>no<p>Three<br>four"
            "<ul><li>first<li>second<ol start=3><li>in</ol></ul><table><tr><th>Name<td>Qty<tr><td>apple pie<td>2</table>"
            "<pre> a\n  b</pre><span style='display: none'>no</span><script>var x='</p>'</script>end &amp; &eacute;")
    assert html_text.rendered(page) == ("Head\n\nOne bold, two\n\nThree\nfour\n\n- first\n- second\n  3. in\n\nName       Qty\napple pie  2\n\n"
                                        " a\n  b\n\nend & é")
    assert html_text.rendered("") == "" and html_text.rendered("plain  text") == "plain text"
    assert html_text.rendered("<div>" * 5000 + "deep") == "deep"
    # the standard passes over end tags of nothing open and cells outside a table
    assert html_text.rendered("</p></td><li>x</ul>y<td>z") == "- xyz"


def test_shingle_sets_of_long_texts(monkeypatch):
    text = " ".join(f"W{i % 700}" for i in range(4000))
    whole = list(shingles.shingle_sets([text, "A b", "", "a B c d e"]))
    monkeypatch.setattr(shingles, "SLICE", 3000)
    monkeypatch.setattr(shingles, "_POWERS", {})
    assert all(np.array_equal(a, b) for a, b in zip(whole, shingles.shingle_sets([text, "A b", "", "a B c d e"])))
    assert [len(x) for x in whole] == [700, 1, 0, 1]


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(120)]
        for _ in range(1 + g * 2):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"z{rng.randint(0, 10_000)}"
            rows.append((1000 - len(rows), " ".join(copy), "a"))
    rows += [(2000, "a b", "a"), (2001, "A  b", "a"), (2002, "", "a"), (2003, None, "a")]
    rng.shuffle(rows)
    sets = {}
    for i, t, _ in rows:
        w = WORDS.findall((t or "").lower())
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    of = {i: i for i in ids}
    for a in ids:
        for b in ids:
            k = len(sets[a] & sets[b])
            if a < b and k and 100 * k >= 85 * len(sets[a] | sets[b]):
                x, y = of[a], of[b]
                of = {i: min(x, y) if c in (x, y) else c for i, c in of.items()}
    got = {r.doc_id: r for r in minhash.grouped(frame(spark, rows)).collect()}
    assert {i: r.component_id for i, r in got.items()} == of
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == of[i]) for i, r in got.items())
    assert sorted(r.doc_id for r in minhash.kept(frame(spark, rows)).collect()) == sorted(set(of.values()))


def test_exact_links_equal_brute_force(spark, monkeypatch):
    """Links that no hub has found: of 60 sets around three bases, none joined so far."""
    rng = random.Random(21)
    bases = [[b * 1000 + i for i in range(100)] for b in range(3)]
    sets = {}
    for i in range(60):
        one = set(bases[i % 3])
        for _ in range(rng.randint(0, 12)):
            one.discard(rng.choice(bases[i % 3]))
            one.add(10_000 + rng.randrange(400))
        sets[i] = one
    for least in (85, 80):
        want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}
        assert 0 < len(want) < 60 * 19 // 2
        frames = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node bigint, shingles array<bigint>")
        nodes = spark.createDataFrame([(i, i) for i in sets], "node bigint, component bigint")
        for strip in (500, 7):
            monkeypatch.setattr(minhash, "STRIP", strip)
            assert {tuple(r) for r in minhash.exact_links(nodes, frames.union(frames), least).collect()} == want


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 90), (100, 91)], "a bigint, b bigint")
    want = {**{i: 1 for i in range(2, 61)}, 91: 90, 100: 90}
    assert {r.node: r.component for r in minhash.components(links).collect()} == want


def test_pipeline_stages_keep_columns(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, sentence(rng, 70) if i % 5 else "JUNK!! " * 40, "ab"[i % 2]) for i in range(60)] + [(100, "the same " + sentence(rng, 3), None)]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(60)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert apply(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= {i for i, _, _ in rows if i % 5}


def test_mixing_reaches_the_rows_of_the_pipeline(spark, tmp_path, monkeypatch):
    rng = random.Random(12)
    rows = [(i, sentence(rng, 70) if i % 5 else "JUNK!! " * 40, "aab"[i % 3]) for i in range(90)]
    rows += [(None, t, s) for s in "ab" for t in (rows[1][1], rows[2][1], rows[1][1])]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(90)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    got = found.collect()
    assert all(x is not None for r in got for x in (r.block, r.slot, r.place))
    assert len({(r.slot, r.place) for r in got}) == len(got) and len({r.slot for r in got}) > 1
    monkeypatch.setattr(corpus_pipeline, "STAGES", [s for s in corpus_pipeline.STAGES if s[0] != "mixing"])
    without = corpus_pipeline.run(spark, str(tmp_path))
    assert without.columns == found.columns
    plain = lambda rs: sorted((str(r.doc_id), r.ids_sha256) for r in rs)
    assert plain(without.collect()) == plain(got) and sorted(map(str, without.collect())) != sorted(map(str, got))


def test_near_copies_by_the_least_similarity_asked(spark):
    """Sets of 91 of which 82 are shared: a similarity of 0.82."""
    words = [f"w{i}" for i in range(95)]
    rows = [(1, " ".join(words), "a"), (2, " ".join(words[:86] + [f"v{i}" for i in range(9)]), "a"), (3, "another text of few words", "a")]
    assert sorted(r.doc_id for r in minhash.kept(frame(spark, rows), 85).collect()) == [1, 2, 3]
    assert sorted(r.doc_id for r in minhash.kept(frame(spark, rows), 80).collect()) == [1, 3]
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, frame(spark, rows), "").collect()) == [1, 3]
    assert minhash.coarse_bands(85).shape == (25, 5) and minhash.coarse_bands(80).shape == (31, 4)


def test_heads_need_no_sort(spark):
    rows = [(f"w{i}", 1 + i % 7 if i % 50 else 1000 + i) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "piece string, freq bigint")
    for head in (10, 60, 700, 5000):
        found = token_counts.frequent(pieces, head)
        assert "TakeOrdered" not in found._jdf.queryExecution().toString()
        got = {r.piece: r.freq for r in found.collect()}
        rest = [f for w, f in rows if w not in got]
        assert len(got) <= 1.3 * head and len(got) >= min(3000, 0.6 * head)
        assert not rest or min(got.values()) >= max(rest) / 1.02
    labels = spark.createDataFrame([(i, i % 2) for i in range(6000)], "doc_id bigint, quality int")
    kept = [i for i, in labels.where(quality.fold(F.col("doc_id")) != 0).select("doc_id").collect()]
    assert sorted(r.doc_id for r in quality.sampled(labels, 10_000).collect()) == sorted(kept)
    found = quality.sampled(labels, 500)
    assert "TakeOrdered" not in found._jdf.queryExecution().toString()
    got = {r.doc_id: r.good for r in found.collect()}
    assert 400 <= len(got) <= 500 and set(got) <= set(kept) and all(g == i % 2 for i, g in got.items())
    assert got == {r.doc_id: r.good for r in quality.sampled(labels.repartition(7), 500).collect()}


def test_ranking_fits_the_likelihood():
    """The weights have the least penalised loss; the threshold cuts off as many training scores as there are bad documents."""
    rng = np.random.default_rng(3)
    d = rng.normal(size=(400, 3)) + np.array([0.8, 0.0, -0.3])
    w = quality.fit_pairs(d, np.zeros_like(d))

    def loss(w):
        return np.log1p(np.exp(-(d @ w))).mean() + quality.PENALTY * (w @ w) / 2

    for step in (0.01, 0.1, 0.5):
        for direction in [*np.eye(3), *rng.normal(size=(20, 3))]:
            assert loss(w) <= loss(w + step * direction) and loss(w) <= loss(w - step * direction)
    x, good = rng.normal(size=(300, len(quality.NAMES))), rng.random(300) < 0.6
    x[good, 0] += 1
    ranking = quality.rank(x, good)
    assert (ranking.score(x) < quality.CUT).sum() == (~good).sum()


def test_base_secrets_equal_the_patterns(spark):
    rng = random.Random(8)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "AKIA", "=", ":", " ", '"', "'", "abc0", "DEADBEEF", "0123456789abcdef", "Zz9+/_.=-",
             "x", "ab12" * 4, "\n", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    kinds = [(assign, lambda m: len(m.group(2)) >= 12), (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
             (re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 16)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secret_scan.scan(rows).collect()}
    for i, text in enumerate(texts):
        spans = sorted((m.start(), k, name, m.end()) for k, ((p, fits), name) in enumerate(zip(kinds, ("assign", "access", "hex"))) for m in p.finditer(text) if fits(m))
        joined = ",".join(f"{name}:{start}:{end}" for start, _, name, end in spans)
        assert got[i] == (*[sum(s[1] == k for s in spans) for k in range(3)], hashlib.sha256(joined.encode()).hexdigest())


def test_repeated_ids_keep_the_least_text(spark):
    docs = spark.createDataFrame([(1, "b c", "x"), (1, "a c", "y"), (1, None, "z"), (2, "q", "x"), (None, "q", "n"), (None, "q", "n")], "doc_id bigint, text string, _llm_place string")
    got = [tuple(r) for r in minhash.kept(docs.withColumnRenamed("_llm_place", "source")).collect()]
    assert sorted(got, key=str) == sorted([(1, None, "z"), (2, "q", "x"), (None, "q", "n"), (None, "q", "n")], key=str)


@pytest.mark.parametrize("html,text", [
    ("<svg><title>no</title><text>drawn</text></svg>", "drawn"),
    ("<select><option>a<option selected>b</select> x", "b x"),
    ("<select><option>a<option>b</select>", "a"),
    ("<select multiple><option>a<option>b</select>", "a b"),
    ('<p aria-hidden="true">seen</p>', "seen"),
    ("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e</table>", "a  b  c\n   d  e"),
    ("<table><tr><td>a<td rowspan=0>b<tr><td>c<td>d<tr><td>e<td>f</table>", "a  b\nc     d\ne     f"),
    ("<style>.x{display:none} @media print{p{display:none}} #k{display:none} p.x{display:block}</style>"
     "<div class='y x'>no</div><p class=x>yes<i id=k>no</i><p>too<p class=x style='display:none'>no", "yes\n\ntoo"),
    ("<style media=print>p{display:none}</style><style>b , i/* , p */{visibility:hidden}</style><p>a<b>no</b><i>no</i>", "a"),
])
def test_html_shows_what_a_reader_sees(html, text):
    assert html_text.rendered(html) == text


def test_html_of_unclosed_tags_takes_linear_time():
    n = 20_000
    for page in ("<div>" * n, "<b>" * n + "</x>" * n, "<p><button>" + "<div>x" * n, "<p>" * n + "</i>" * n, "<ul><li>x" * n, "<blockquote>x" * n,
                 "<table><tr><td rowspan=99999>x" * 50 + "<td>y" * n):
        start = time.process_time()
        html_text.rendered(page)
        assert time.process_time() - start < 5


def test_html_words_equal_a_plain_walk(spark):
    """The given pages: the characters in any order are those outside of hidden elements, found by a parser without tree or layout."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.words, self.inside = [], 0

        def handle_starttag(self, tag, attrs):
            gone = tag in html_text.HIDDEN or "hidden" in dict(attrs) or html_text.GONE.search(dict(attrs).get("style") or "")
            if tag not in html_text.VOID and (self.inside or gone):
                self.inside += 1

        def handle_endtag(self, tag):
            self.inside = max(0, self.inside - 1)

        def handle_data(self, data):
            if not self.inside:
                self.words += data.split()

    marks = re.compile(r"-|---|\d+\.")
    for (html,) in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect():
        plain = Plain()
        plain.feed(html or "")
        plain.close()
        shown = [w for w in html_text.rendered(html or "").split() if not marks.fullmatch(w)]
        assert sorted("".join(shown)) == sorted("".join(w for w in plain.words if not marks.fullmatch(w)))


def test_ranking_learns_from_every_label(spark, monkeypatch):
    """One label more changes the fit; groups of 40 fit the likelihood of their pairs and the threshold counts all bad documents."""
    rng = random.Random(4)
    rows = [(i, sentence(rng, 60 + i % 17) + " !!" * (rng.random() < (0.2 if i % 7 else 0.8)), "a") for i in range(600)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 7 > 0)) for i in range(600)], "doc_id bigint, quality int")
    found = quality.nodes(docs, labels)
    kept = [i for i in range(600) if __import__("zlib").crc32(str(i).encode()) % 5]
    assert found.agg(F.sum("n")).first()[0] == len(kept)
    mean, spread = np.zeros(len(quality.XS)), np.ones(len(quality.XS))
    pairs = quality.paired(found, mean, spread, 40)
    m = np.concatenate([np.frombuffer(r.d).reshape(-1, len(quality.XS) + 1) for r in pairs.collect()])
    assert pairs.count() > 5 and (m[:, -1] == 1).all() and len(m) >= 4 * found.where("good").count()
    assert np.abs(quality.fit_all(pairs, len(quality.XS)) - quality.fit_pairs(m[:, :-1], np.zeros_like(m[:, :-1]))).max() < 1e-6
    ranking = quality.fit(docs, labels)
    x = np.array([quality.features(rows[i][1]) for i in kept])
    assert (ranking.score(x) < quality.CUT).sum() == sum(i % 7 == 0 for i in kept)
    assert quality.fit(docs.repartition(5), labels.repartition(3)) == ranking
    assert quality.fit(docs, labels.where(f"doc_id <> {kept[-1]}")) != ranking
