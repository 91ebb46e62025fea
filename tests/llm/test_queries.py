"""Every registered query on small hard tables, against plain Python written apart from it."""

import base64
import hashlib
import random
import re
import struct
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from tessella.llm import queries as Q
from tessella.llm.queries import QUERIES

CLASH = ["size", "key", "node", "target", "shard", "slot", "cut", "text_hash", "b", "_id", "_key", "_hash", "_own", "weight"]
SYLLABLES = ["ka", "lo", "mi", "ren", "su", "to", "vel", "ñu", "éo", "ß"]


def _passage(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def _documents():
    rng = random.Random(3)
    texts = [_passage(rng, rng.randint(5, 120)) for _ in range(60)]
    common = _passage(rng, 60)
    texts += [f"{_passage(rng, 40)} {common} {_passage(rng, 30)}" for _ in range(6)]
    for base in texts[:5]:
        words = (base + " " + _passage(rng, 200)).split(" ")
        near = list(words)
        near[len(words) // 2] = "changed"
        texts += [" ".join(words), " ".join(near), " ".join(words).upper()]
    texts += [_passage(rng, 300)] * 7
    texts += [_passage(rng, 20_000), "ab " * 3_000, "x" * 5_000, None, None, "", "", " \t\n", "one", "One", "two words", "!?", "😀 \x1c end\x00"]
    rows = [(i + 1, t, ["en", "de", None][i % 3], ["hot", "hot", "web", None][i % 4]) for i, t in enumerate(texts)]
    return rows + [(None, "a text without an id " + _passage(rng, 30), "en", "web"), (None, None, None, None)]


DOCS = _documents()
LABELS = [(i, i % 2, i % 3 % 2) for i in range(1, 90)] + [(3, None, None), (None, 1, 1), (4, 0, 1), (10_000, 1, 0)]


def _vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    rows = [v for v in base] + [v + rng.normal(size=16) * 0.03 for v in base[:20] for _ in range(3)] + [base[0] * 2, base[0], base[0]]
    rows = [list(map(float, np.float32(v))) for v in rows]
    rows += [None, [None] * 16, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, []]
    return list(enumerate(rows))


VECTORS = _vectors()
PAGES = [(i, f"u{i % 4}", [None, "", "<p>é</p>", f"<p>{i}</p>", "long " * 40_000][i % 5]) for i in range(1, 41)]


def _turns():
    rng = random.Random(7)
    texts = [None, "", "plain ##### text", "### user: hi</turn>\n", "\\", "\\</turn>\\", "#\\##", "é😀 ### </turn", "a: b"]
    roles = ["user", "assistant", "system", None, "tool: x", "assistant", ":", "</turn>\n"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(12) for t in range(rng.randint(1, 9))]
    rows += [(50, t, ["user", "assistant"][t % 2], f"turn {t}") for t in range(150)]
    return rows + [(60, 1, "assistant", "same"), (60, 1, "assistant", "same"), (60, 0, "user", "same"), (60, None, "user", "late"), (None, 0, "assistant", "no id")]


TURNS = _turns()


def _write(folder, documents, labels, vectors, pages, turns):
    n = len(documents)
    cols = list(zip(*documents)) if n else [[]] * 4
    types = [pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["doc_id", "text", "lang", "source"]
    arrays = [pa.array(c, t) for c, t in zip(cols, types)]
    arrays.append(pa.array([None if r[1] is None else len(r[1]) for r in documents], pa.int64()))
    arrays += [pa.array(["other"] * n, pa.string())] * len(CLASH)
    write = lambda name, table: pq.write_table(table, f"{folder}/{name}.parquet")
    write("documents", pa.Table.from_arrays(arrays, names + ["n_chars"] + CLASH))
    column = lambda rows, i, t: pa.array([r[i] for r in rows], t)
    i32, i64 = pa.int32(), pa.int64()
    write("labels", pa.Table.from_arrays([column(labels, 0, i64), column(labels, 1, i32), column(labels, 2, i32)], ["doc_id", "quality", "toxic"]))
    vec = [column(vectors, 0, i64), column(vectors, 1, pa.list_(pa.float32())), pa.array([0] * len(vectors), i32), pa.array(["x"] * len(vectors))]
    write("embeddings", pa.Table.from_arrays(vec, ["vec_id", "embedding", "label", "node"]))
    page = [column(pages, 0, i64), column(pages, 1, pa.string()), column(pages, 2, pa.string()), pa.array(["x"] * len(pages))]
    write("pages", pa.Table.from_arrays(page, ["page_id", "url", "html", "payload"]))
    turn = [column(turns, 0, i64), column(turns, 1, i64), column(turns, 2, pa.string()), column(turns, 3, pa.string()), pa.array(["x"] * len(turns))]
    write("conversations", pa.Table.from_arrays(turn, ["conv_id", "turn", "role", "text", "tree"]))
    return str(folder)


@pytest.fixture(scope="module")
def hard(tmp_path_factory):
    return _write(tmp_path_factory.mktemp("hard"), DOCS, LABELS, VECTORS, PAGES, TURNS)


@pytest.fixture(scope="module")
def nothing(tmp_path_factory):
    return _write(tmp_path_factory.mktemp("nothing"), [], [], [], [], [])


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, nothing, name):
    rows = QUERIES[name](spark, nothing).collect()
    if name == "op12_chat_format":  # the conversation that the query adds
        assert [(r.conv_id, r.n_turns, r.loss_chars) for r in rows] == [(-7, 2, 26)]
    else:
        assert rows == []


def test_empty_tables_through_the_pipeline(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).collect() == []


def test_mixing_meets_its_targets(spark, hard):
    rows = Q.op1_mix_sources(spark, hard).collect()
    assert len(rows) == len(DOCS)
    source = {d[0]: d[3] for d in DOCS}
    total, sizes, taken, target = 0, Counter(), Counter(), {}
    for r in rows:
        name = source[r.doc_id] if r.doc_id is not None else ("web" if r.size else None)
        sizes[name] += r.size
        taken[name] += r.taken
        target[name] = r.target
        assert 0 <= r.taken <= 2 * r.size
    for doc in DOCS:
        total += len(_words(doc[1]))
    assert sum(sizes.values()) == total
    assert all(t <= 2 * sizes[s] + 1e-6 for s, t in target.items())
    assert abs(sum(target.values()) - 1.5 * total) < 1e-3
    most = defaultdict(int)
    for doc in DOCS:
        most[doc[3]] = max(most[doc[3]], len(_words(doc[1])))
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)
    assert sorted(map(str, rows)) == sorted(map(str, Q.op1_mix_sources(spark, hard).collect()))


def test_top_k_equals_all_products(spark, hard):
    usable = {i: v for i, v in VECTORS if v and all(x is not None and np.isfinite(x) for x in v)}
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, v in usable.items()}
    expected = []
    for q in ints:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:5]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in Q.op2_exact_topk(spark, hard).collect()]
    assert sorted(got) == sorted(expected)


def test_near_vectors_equal_all_cosines(spark, hard):
    usable = {i: np.array(v, float) for i, v in VECTORS if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in usable.items()}
    links = [(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= 0.95]
    root = _components([i for i, _ in VECTORS], links)
    degree = Counter(x for pair in links for x in pair)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in Q.op3_nn_descent(spark, hard).collect()}
    assert got == {i: (degree[i], root[i], root[i] == i) for i, _ in VECTORS}


def test_archives_give_back_every_page(spark, hard):
    groups = defaultdict(list)
    for i, _, html in PAGES:
        groups[(html or "").encode()].append(i)
    expected = set()
    for payload, ids in groups.items():
        code = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for i in ids:
            first = i == max(ids)
            expected.add((i, len(payload), code, "response" if first else "revisit", None if first else max(ids)))
    rows = Q.op4_warc_round_trip(spark, hard).collect()
    assert len(rows) == len(PAGES)
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows} == expected


def test_encoding_equals_the_tokenizers_library(spark, hard):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(Q.tokenizer_file())
    model.no_truncation(), model.no_padding()
    expected = Counter()
    for i, text, *_ in DOCS:
        ids = model.encode(text or "", add_special_tokens=False).ids
        packed = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        plain = hashlib.sha256(model.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        expected[(i, len(ids), packed, plain)] += 1
    rows = Q.op5_bpe_round_trip(spark, hard).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == expected


def test_every_text_is_encoded_once(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    for df in (Q.op5_bpe_round_trip(spark, hard), corpus_pipeline.tokens(spark, docs, hard)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_ids_decode_by_themselves(spark, hard):
    from tessella.llm import bpe

    path = Q.tokenizer_file()
    rows = bpe.coded(spark.read.parquet(f"{hard}/documents.parquet"), path, "ids", "packed", "decoded", into="key")
    rows = rows.withColumn("again", bpe.decoded(path)("key.ids")).collect()
    assert len(rows) == len(DOCS) and all(r.again == r.key.decoded for r in rows)
    assert all(list(r.key.ids) == np.frombuffer(r.key.packed, "<u4").tolist() for r in rows)


def _shingles(text, width):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = _words(lower)
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def test_jaccard_join_equals_all_pairs(spark, hard):
    sets = {i: _shingles(text, 3) for i, text, *_ in DOCS if i is not None}
    ids = sorted(sets)
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    root = _components(ids, links)
    rows = Q.op6_ngram_jaccard(spark, hard).collect()
    assert len(rows) == len(DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert got == {i: (len(sets[i]), root[i]) for i in ids}


def test_repeated_strings_equal_a_table_of_all_windows(spark, hard):
    raw = [(i, (text or "").encode()) for i, text, *_ in DOCS]
    seen = Counter(data[p : p + 200] for _, data in raw for p in range(len(data) - 199))
    expected = Counter()
    for i, data in raw:
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 199):
            if seen[data[p : p + 200]] > 1:
                gone[p : p + 200] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        expected[(i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    rows = Q.op8_suffix_dedup(spark, hard).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == expected


def test_hot_anchors_are_settled_alike(spark, hard):
    from tessella.llm.repeats import remove_repeats

    docs = spark.read.parquet(f"{hard}/documents.parquet").select("doc_id", "text")
    digest = lambda hot: sorted((str(r.doc_id), bytes(r.cut.kept)) for r in remove_repeats(docs, hot_contexts=hot).collect())
    assert digest(1) == digest(20_000)


def test_shards_are_gapless_and_near_equal(spark, sf_dir, hard):
    for folder in (sf_dir, hard):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
        rows = Q.op10_shard_bytes(spark, folder).collect()
        data = lambda t: (t or "").encode()
        assert Counter((i, len(data(t)) + 16, zlib.crc32(data(t))) for i, t in docs) == Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
        slots, sizes = defaultdict(list), Counter()
        for r in rows:
            slots[r.shard].append(r.slot)
            sizes[r.shard] += r.size
            assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < 40
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        share, largest = sum(sizes.values()) / 40, max(r.size for r in rows)
        assert max(sizes.values()) <= 1.02 * share + largest


def test_language_on_held_out_documents(spark, hard):
    folder = "/root/testdata/sf0.01"
    told = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in Q.op9_language(spark, folder).collect() if r.held_out]
    right = [told[r.doc_id] == r.lang_pred for r in rows]
    assert len(rows) > 100 and sum(right) / len(right) >= 0.9
    text = {d[0]: d[1] for d in DOCS if d[0] is not None}
    found = Q.op9_language(spark, hard).collect()
    assert len(found) == len(DOCS)
    for r in found:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and not any(c.isalpha() for c in text[r.doc_id] or ""):
            assert r.lang_pred == "und"


def test_toxicity_on_held_out_documents(spark, hard):
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in Q.op7_toxicity(spark, folder).collect() if r.held_out and toxic.get(r.doc_id) is not None]
    rank = sorted(rows, key=lambda r: r.score)
    positives = sum(toxic[r.doc_id] for r in rows)
    below = won = 0
    for r in rank:
        if toxic[r.doc_id]:
            won += below
        else:
            below += 1
    assert won / (positives * (len(rows) - positives)) >= 0.8
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    found = Q.op7_toxicity(spark, hard).collect()
    assert len(found) == len(DOCS) and all(0 <= r.score <= 1 for r in found)


def _sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_codes_equal_plain_rounds(spark, hard):
    usable = [(i, v) for i, v in VECTORS if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = {}
    for width in {len(v) for _, v in usable}:
        rows = [(i, np.array([int(np.floor(256 * x)) for x in v], object).reshape(16, -1)) for i, v in usable if len(v) == width]
        book = [[v[p] for _, v in rows[:64]] for p in range(16)]
        near = lambda x, entries: min((int(((x - c) ** 2).sum()) if len(x) else 0, e) for e, c in enumerate(entries))
        for _ in range(2):
            for p in range(16):
                told = defaultdict(list)
                for _, v in rows:
                    told[near(v[p], book[p])[1]].append(v[p])
                book[p] = [sum(told[e]) // len(told[e]) if told[e] else c for e, c in enumerate(book[p])]
        digests = _sha(",".join(str(x) for part in book for c in part for x in c))
        for i, v in rows:
            found = [near(v[p], book[p]) for p in range(16)]
            expected[i] = ("".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), digests)
    total = sum(e for _, e, _ in expected.values())
    rows = Q.op11_vector_codes(spark, hard).collect()
    assert {r.vec_id: (r.code, r.error, r.codebooks_sha256) for r in rows} == expected and len(rows) == len(usable)
    assert {r.label_error for r in rows} == {total}


def test_chats_read_back_as_they_were(spark, hard):
    rows = TURNS + [(-7, 0, "user", Q.HARD_TURN), (-7, 1, "assistant", Q.HARD_TURN)]
    expected = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1]))
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        expected[conv] = (len(own), _sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)), len(learned), _sha(learned))
    found = Q.op12_chat_format(spark, hard).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == expected
    assert len(found) == len(expected)


def test_infill_equals_plain_cuts(spark, hard):
    expected = Counter()
    for i, text, *_ in DOCS:
        text = text or ""
        units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        h = _sha(f"42:{'' if i is None else i}")
        h = [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]
        cut = sorted(x % (len(units) + 1) for x in h[:2])
        p, m, s = "".join(units[: cut[0]]), "".join(units[cut[0] : cut[1]]), "".join(units[cut[1] :])
        plain = not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50
        form = "plain" if plain else "spm" if h[3] % 100 < 80 else "psm"
        output = {"plain": text, "spm": f"<S>{s}<P>{p}<M>{m}", "psm": f"<P>{p}<S>{s}<M>{m}"}[form]
        chars = (None, None) if plain else (len(p), len(m))
        expected[(i, len(units), form, *chars, _sha(output), _sha(text))] += 1
    rows = Q.op13_fill_in_middle(spark, hard).collect()
    assert Counter(map(tuple, rows)) == expected


def test_stages_on_hard_tables(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["near_duplicates"](spark, docs, hard)
    assert kept.columns == corpus_pipeline.COLUMNS
    left = [r.doc_id for r in kept.collect()]
    sets = {i: _shingles(text, 5) for i, text, *_ in DOCS if i is not None}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    root = _components(sorted(sets), links)
    assert sorted(i for i in left if i is not None) == sorted(i for i in sets if root[i] == i)
    out = corpus_pipeline.run(spark, hard).collect()
    assert out and all(r.n_tokens == len(r.ids) for r in out)
