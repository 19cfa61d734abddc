"""The dealt operators against brute force, on small tables with every awkward case."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("tabprep.llm")

from pyspark.sql import functions as F

from tabprep.llm import byte_bpe, common, components, cross_polytope, decontaminate, importance, log_bilinear, piece_bpe, pivot_clusters, secrets, sharding, simhash, token_files, warc, whitening, whole_vectors

#: Columns whose names the operators use inside.
CLASHES = ("key", "row", "ids", "fp", "n", "size", "shard", "digest", "component", "score", "items", "window", "begin", "at", "spans", "vector", "kept")
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Alpha beta gamma"),
    (3, ""),
    (4, None),
    (5, "seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
    (None, "lonely item without a key"),
]


def texts():
    r = random.Random(7)
    words = ["the", "cat", "naïve", "Zürich", "中文", "x1", "don't", "end.", "A", "ALPHA", "beta", "gamma", "beta", "secret", "pass"]
    out = [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(40)]
    out += [out[0], out[0], out[1] + " more", None, None, "", " ", "\n\n  two  spaces\t\n ", "x" * 5000, "ab " * 3000, "👍🏽 émoji   line \x1c sep"]
    out += ["say " + ITEMS[0][1] + " stop", ITEMS[0][1].upper().replace(" ", "; "), "two three four five six seven eight nine ten", "alpha, BETA gamma; alpha beta gamma gamma"]
    out += ["one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 3]
    key = "AKIA" + "Q" * 14
    out += [
        f'password = "hunter2hunter2" and {key} é {key}', "token==secret=abcdefgh", "token=secret: abcdefgh12", "api_key:'short' APIKEY=longenough1",
        "0123456789abcdef" * 2 + "0 " + "0123456789ABCDEF" * 2, f"é{key}x {key}", "x aB3dE6gH9jK2mN5pQ8sT1v y", "z Zz3dE6gH9jK2mN5pQ8sT1v-_/ y", "token=aB3dE6gH9jK2mN5pQ8sT1v",
    ]
    return out


def rows():
    out = [(i, t, f"s{i % 4}" if i % 9 else None, "en" if i % 2 else None, None, *CLASHES) for i, t in enumerate(texts())]
    out.append(out[3])  # a repeated row
    out.append((None, "a document without a key", None, None, None, *CLASHES))
    out.append((None, None, None, None, None, *CLASHES))
    out.append((-5, out[7][1], "s9", "en", None, *CLASHES))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(found=()):
    return collections.Counter(found)


def test_byte_bpe(docs, none):
    import public_tokenizers
    import tiktoken

    v = byte_bpe.Vocabulary.of_file(byte_bpe.default_path())
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks(), special_tokens={})
    found = byte_bpe.decode(byte_bpe.encode(docs, "doc_id", "text", v, decoded=True), "ids", v, "again").collect()
    want = bag((r[0], tuple(own.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows())
    assert bag((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), bytes(r.decoded)) for r in found) == want
    assert all(r.again == r.decoded and r.n_tokens == len(r.ids) // 4 for r in found)
    assert byte_bpe.encode(none, "doc_id", "text", v).count() == 0


def test_rank_queue_on_long_and_odd_pretokens():
    import tiktoken

    v = byte_bpe.Vocabulary.of_file(byte_bpe.default_path())
    e = byte_bpe.Encoder(v)
    own = tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks=v.ranks(), special_tokens={})
    r = random.Random(3)
    for n in (1, 2, 50, 20_000):
        for letters in ("a", "ab", "the"):
            text = "".join(r.choice(letters) for _ in range(n))
            assert np.frombuffer(e(text), "<u4").tolist() == own.encode_ordinary(text)
    # the queue breaks ties to the left and survives a merge that makes a lower rank
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"aa": 300, b"aaa": 5, b"ab": 301, b"aab": 2}
    q = byte_bpe.RankQueue(ranks)
    assert [[k for k, x in ranks.items() if x == i][0] for i in q.merge(b"aaaab")] == [b"aaa", b"ab"]
    assert not q.buckets and not any(q.words)


def test_byte_bpe_under_another_pattern_and_a_full_memo(monkeypatch):
    """A pre-token that reaches over single spaces is not cut there; the memo forgets and stays within its bytes."""
    import tiktoken

    v = byte_bpe.Vocabulary.of_file(byte_bpe.default_path(), pattern=r"\w+ \w+|\S+|\s")
    own = tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks=v.ranks(), special_tokens={})
    told = byte_bpe.Vocabulary.of_file(byte_bpe.default_path())
    same = tiktoken.Encoding("same", pat_str=told.pattern, mergeable_ranks=v.ranks(), special_tokens={})
    monkeypatch.setattr(byte_bpe, "HELD_BYTES", 4000)
    e, f = byte_bpe.Encoder(v), byte_bpe.Encoder(told)
    for t in texts() * 2:
        t = t or ""
        assert np.frombuffer(e(t), "<u4").tolist() == own.encode_ordinary(t)
        assert np.frombuffer(f(t), "<u4").tolist() == same.encode_ordinary(t)
        assert f.memo.held <= 4000
    assert f.memo.older and byte_bpe.SPACE_PATTERN == told.pattern


def test_elias_fano():
    r = np.random.default_rng(0)
    for n, most in ((1, 0), (3, 0), (700, 3), (2000, 100_000)):
        values = np.concatenate([[0], np.cumsum(r.integers(0, most + 1, n))])
        packed = token_files.EliasFano.of(values)
        assert (packed[np.arange(len(values))] == values).all()
        assert packed[np.array([len(values) - 1, 0])].tolist() == [values[-1], 0]
        bits = 8 * (packed.low.nbytes + packed.high.nbytes + packed.samples.nbytes)
        assert bits <= len(values) * (3 + math.log2(max(2, values[-1] / len(values)))) + 200


def test_token_files(docs, none, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    monkeypatch.setattr(token_files, "FILE", 2000)  # several files per task
    told = token_files.Tokenizer.of_file(path, 0)
    manifest = token_files.write_files(docs, "doc_id", "text", told)
    found = token_files.read_files(manifest, "doc_id", "bigint").orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows()), key=lambda k: (k is not None, k))
    assert [r.start for r in found] == [0, *itertools.accumulate(r.n_tokens for r in found)][:-1]
    ids = lambda t: model.encode(t or "", add_special_tokens=False).ids + [0]
    want = bag((r[0], len(ids(r[1])), zlib.crc32(np.array(ids(r[1]), "<u4").tobytes())) for r in rows())
    assert bag((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want
    assert token_files.read_files(token_files.write_files(none, "doc_id", "text", told), "doc_id", "bigint").count() == 0
    plain = token_files.tokenize(docs, "doc_id", "text", told).collect()
    assert bag((r.doc_id, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in plain) == bag((r[0], tuple(ids(r[1]))) for r in rows())


def test_token_memo_over_several_rollovers(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    monkeypatch.setattr(token_files, "REMEMBERED", 4)
    worker = token_files._Worker(token_files.Tokenizer.of_file(path, 0))
    # the stem stands in the generation that goes when the marked word comes
    texts = ["a foo bar cat dog", "a one two three four", "a foo, bar. x1", "a foo cat, one. foo. foo", "a dog, two, b c d e f g h", "a foo, foo foo."]
    for _ in range(3):
        for t in texts:
            assert np.frombuffer(worker([t])[0], "<u2").tolist() == model.encode(t, add_special_tokens=False).ids
    r = random.Random(1)
    for _ in range(200):
        t = " ".join(r.choice(["foo", "bar", "cat", "zebra", "Zürich", "x1"]) + r.choice(["", "", ",", "."]) for _ in range(r.randint(1, 6)))
        assert np.frombuffer(worker([t])[0], "<u2").tolist() == model.encode(t, add_special_tokens=False).ids


def test_token_files_with_added_tokens(spark, tmp_path):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    told = json.loads(open(path, encoding="utf-8").read())
    plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
    more = [{"id": 70_000, "content": "foo bar", "special": False, **plain}, {"id": 70_001, "content": "<x>", "special": True, **plain, "lstrip": True}]
    other = tmp_path / "more.json"
    other.write_text(json.dumps(told | {"added_tokens": [*told["added_tokens"], *more]}), encoding="utf-8")
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>, <|endoftext|>. y", "a foo bar b", "foo, bar <x> b", "a  <x>", "foo", "bar a foo", "<|endoftext |>", "", "b a. a, b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for file in (path, str(other)):
        model, tokenizer = Tokenizer.from_file(file), token_files.Tokenizer.of_file(file, 0)
        found = token_files.tokenize(df, "doc_id", "text", tokenizer).collect()
        want = {k: model.encode(t, add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
        assert {r.doc_id: np.frombuffer(r.ids, f"<u{tokenizer.width}").tolist() for r in found} == want


def test_warc(spark, monkeypatch):
    long = "<p>é" + "y" * 120
    pages = [(5, "http://a/é b", long), (2, None, long), (9, "u\r\nX: y", long), (3, "u", "short"), (4, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", long),
             (None, "u", "z" * 100), (None, "u", "z" * 100), (2, None, long), (8, "u", "WARC/1.1\r\n\r\n" * 30), (10, "u", "k" * 600_000)]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, digest string, file string").repartition(3)
    monkeypatch.setattr(warc, "FRAME", 700)
    index = warc.write_archives(df, "page_id", "url", "html")
    found = warc.resolve(warc.read_archives(index)).collect()
    first = {}
    for k, _, h in pages:
        if h and len(h.encode()) >= 100 and k is not None:
            first[h] = min(k, first.get(h, k))
    want = bag()
    for k, _, h in pages:
        raw = (h or "").encode()
        least = first.get(h) if len(raw) >= 100 else None
        again = least is not None and k != least
        want[f"<urn:page:{k}>", "revisit" if again else "response", f"<urn:page:{least}>" if again else None, len(raw), hashlib.sha256(raw).hexdigest()] += 1
    assert bag((r.id, r.type, r.refers_to, r.payload_bytes, r.payload_digest) for r in found) == want
    one = warc.fetch(index, spark.createDataFrame([(5,), (10,), (77,)], "page_id long"), "page_id").collect()
    got = {r.page_id: next(warc.parse(bytes(r.record))) for r in one}
    assert set(got) == {5, 10} and got[5][0]["warc-refers-to"] == "<urn:page:2>" and got[10][1] == b"k" * 600_000
    import zstandard

    for r in index.select("file").distinct().collect():  # any reader of Zstandard reads the bundles
        raw = warc.reader(r.file).read()
        assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read().startswith(b"WARC/1.1\r\n")
    assert warc.read_archives(warc.write_archives(df.limit(0), "page_id", "url", "html")).count() == 0


def test_cross_polytope(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(60, 24))
    vectors = [list(map(float, v)) for v in base]
    for i in range(0, 60, 2):
        vectors += [list(map(float, base[i] + r.normal(scale=s, size=24))) for s in (0.05, 0.2, 0.35)]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[1]], [x * 1e-200 for x in vectors[2]], [-x for x in vectors[3]]]
    vectors += [None, [], [0.0] * 24, [None, *vectors[0][1:]], [math.nan, *vectors[0][1:]], [math.inf, *vectors[0][1:]], vectors[0][:8], vectors[0][:8]]
    data = [(i * 3, v, "x") for i, v in enumerate(vectors)] + [(0, vectors[0], "x"), (None, vectors[5], "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, node string").repartition(4)
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if ok(v) else None for _, v, _ in data]
    near = [[j for j, b in enumerate(unit) if i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9] for i, a in enumerate(unit)]
    want = bag()
    for i, (k, _, _) in enumerate(data):
        seen, todo = {i}, [i]
        while todo:
            todo = [j for x in todo for j in near[x] if j not in seen and not seen.add(j)]
        named = [data[j][0] for j in seen if data[j][0] is not None]
        want[k, len(near[i]), min(named) if named else None] += 1
    got = bag(tuple(x) for x in cross_polytope.neighbours(df, "vec_id", "embedding").select("vec_id", "n_links", "component").collect())
    assert got == want
    assert cross_polytope.neighbours(df.limit(0), "vec_id", "embedding").count() == 0


def test_cross_polytope_blocks_count_each_pair_once(spark, monkeypatch):
    r = np.random.default_rng(2)
    centre = r.normal(size=16)
    data = [(i, list(map(float, centre + r.normal(scale=0.05, size=16)))) for i in range(90)]
    monkeypatch.setattr(cross_polytope, "BLOCK", 20)  # a group of near copies over many blocks
    got = cross_polytope.neighbours(spark.createDataFrame(data, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()
    assert {(x.n_links, x.component) for x in got} == {(89, 0)} and len(got) == 90


def test_cross_polytope_of_many_lengths(spark):
    # of every length two near vectors and one far off; of length 40 so many that they are hashed
    near = "transform(sequence(1, 1 + id div 3), x -> cast(CASE id % 3 WHEN 0 THEN x WHEN 1 THEN x + 0.01 ELSE IF(x % 2 = 0, x, -x) END AS double))"
    df = spark.range(3 * 1100).selectExpr("id", f"{near} AS v")
    more = spark.range(200).selectExpr("10000 + id AS id", "transform(sequence(1, 40), x -> IF(x = 1 + id div 5, 10D, IF(x = 41 - id % 5, 1D, 0D))) AS v")
    got = {r.id: (r.n_links, r.component) for r in cross_polytope.neighbours(df.union(more), "id", "v").collect()}
    assert len(got) == 3500
    assert all(got[3 * n] == got[3 * n + 1] == (1, 3 * n) and got[3 * n + 2] == (0, 3 * n + 2) for n in range(1100))
    assert all(got[10000 + n] == (4, 10000 + n - n % 5) for n in range(175))


def test_jump_hash_and_shards(docs, none):
    def one(key, n):
        b, j = -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
        return b

    keys = np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 2000)
    for n in (1, 2, 24, 1000):
        assert sharding.jump(keys, n).tolist() == [one(int(k) % (1 << 64), n) for k in keys]
    moved = sharding.jump(keys, 24) != sharding.jump(keys, 25)
    assert (sharding.jump(keys, 25)[moved] == 24).all() and 40 < moved.sum() < 130
    found = sharding.assign(docs, "doc_id", "text", 24).collect()
    raw = lambda t: (t or "").encode()
    assert bag((r.doc_id, r.size, r.text_crc32) for r in found) == bag((r[0], len(raw(r[1])) + 8, zlib.crc32(raw(r[1]))) for r in rows())
    assert all(r.law == "key" and r.grown_shard in (r.shard, 24) for r in found)
    assert len({(r.doc_id, r.shard) for r in found}) == len({r.doc_id for r in found})
    for shard, own in itertools.groupby(sorted(found, key=lambda r: (r.shard, r.slot)), key=lambda r: r.shard):
        own = list(own)
        assert 0 <= shard < 24 and [r.slot for r in own] == list(range(len(own)))
    assert sharding.assign(none, "doc_id", "text", 24).count() == 0


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, shingle string")
    found = decontaminate.contamination(docs, "doc_id", "text", items, "item_id", "text").collect()
    want = bag()
    for r in rows():
        w, hit, its = words_of(r[1]), set(), set()
        for item, text in ITEMS:
            v = words_of(text)
            for i in range(len(v) - min(10, len(v)) + 1 if v else 0):
                window = v[i : i + 10]
                for p in range(len(w) - len(window) + 1):
                    if w[p : p + len(window)] == window:
                        hit |= set(range(p, p + len(window)))
                        its |= {str(item)} if item is not None else set()
        want[r[0], len(w), len(hit), tuple(sorted(its))] += 1
    assert bag((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == want
    assert sum(k[2] > 0 for k in want) > 3
    no_items = decontaminate.contamination(docs, "doc_id", "text", items.limit(0), "item_id", "text").collect()
    assert len(no_items) == len(rows()) and not any(r.n_hit or r["items"] for r in no_items)
    assert decontaminate.contamination(none, "doc_id", "text", items, "item_id", "text").count() == 0
    kept = decontaminate.clean(docs, "text", items, "item_id", "text")
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[2])


def test_words_against_plain_code():
    import pyarrow as pa

    from tabprep.llm.words import LETTERS, SOLID, Words

    column = pa.array([t for t in texts()])
    for kinds, split in ((LETTERS, words_of), (SOLID, lambda t: [w.decode() for w in (t or "").encode().lower().split()])):
        for part in (column, column.slice(5, 9), column.slice(43, 3)):
            found, want = Words(part, kinds), [split(t) for t in part.to_pylist()]
            assert np.diff(found.first).tolist() == [len(w) for w in want]
            flat = [w for own in want for w in own]
            assert [found.text(i, i + 1) for i in range(len(flat))] == flat
            assert len(set(zip(flat, found.hashes.tolist(), strict=True))) == len(set(flat)) == len(set(found.hashes.tolist()))


def test_golay():
    code = simhash.Golay()
    words = np.random.default_rng(0).integers(0, 1 << 23, 3000).astype(np.uint32)
    index = code.index(words)
    codeword = words ^ code.error[code.syndrome(words)]
    assert (code.syndrome(codeword) == 0).all() and (codeword >> 11 == index).all()
    assert sorted(np.bincount(np.bitwise_count(code.error)).tolist()) == [1, 23, 253, 1771]
    for flip in range(23):  # a one-bit neighbour is filed where the other looks
        other = words ^ np.uint32(1 << flip)
        probes = np.stack([code.index(other ^ np.uint32(f)) for f in [0, *(1 << b for b in range(23))]], axis=1)
        assert (probes == index[:, None]).any(axis=1).all()


def plain_fingerprint(text, length=3):
    import xxhash

    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + length]) for i in range(max(1, len(w) - length + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_links_all_near_prints(spark):
    r = random.Random(5)
    prints = [r.getrandbits(64) for _ in range(300)]
    prints += [p ^ (1 << a) ^ (1 << b) for p in prints[:250] for a, b in [(r.randrange(64), r.randrange(64))]]
    prints += [prints[0] ^ 7, 0, 1, 3, 7, (1 << 64) - 1]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    got = {(x.a, x.b) for x in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 2).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(signed, 2) if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2}


def test_simhash_broadcasts_no_filed_prints(spark):
    """Both sides are many times their fingerprints, which Spark does not see; nor does a row per document go to the driver."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    prints = spark.createDataFrame([(1,), (2,), (1 << 60,)], "fp long")
    assert "BroadcastHashJoin" not in plan(simhash.links(prints, 2))
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "")], "doc_id long, text string")
    assert "BroadcastHashJoin" not in plan(simhash.groups(docs, "doc_id", "text"))


def test_simhash(docs, none):
    data = rows()
    fp = [plain_fingerprint(r[1]) for r in data]
    found = simhash.groups(docs, "doc_id", "text").collect()
    parent = list(range(len(data)))
    for i, j in itertools.combinations(range(len(data)), 2):
        if bin(fp[i] ^ fp[j]).count("1") <= 2:
            a, b = parent[i], parent[j]
            parent = [a if p == b else p for p in parent]
    name = {p: min((data[i][0] for i in range(len(data)) if parent[i] == p and data[i][0] is not None), default=None) for p in set(parent)}
    assert bag((r.doc_id, r.fp & (1 << 64) - 1, r.component) for r in found) == bag((r[0], f, name[p]) for r, f, p in zip(data, fp, parent, strict=True))
    assert simhash.groups(none, "doc_id", "text").count() == 0
    kept = simhash.keep_one(docs, "doc_id", "text")
    assert kept.columns == docs.columns
    assert bag(r.doc_id for r in kept.collect()) == bag(name.values())


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, x) for x in range(2001, 2100)]
    found = {x.node: x.component for x in components.components(spark.createDataFrame([*edges, (None, 5), (7, 7)], "a long, b long"), "a", "b").collect()}
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        new = {x: min([label[x], *(label[b if a == x else a] for a, b in edges if x in (a, b) and a != b)]) for x in label} if len(label) < 60 else label
        for a, b in edges:
            if a != b:
                new[a] = new[b] = min(new[a], new[b])
        if new == label and all(label[a] == label[b] for a, b in edges if a != b):
            break
        label = new
    assert found == label


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def all_spans(data):
    """Per row, spans with the number of owners of their value."""
    found, owners = [], collections.defaultdict(set)
    for r in data:
        t = r[1] or ""
        more = [(m.start(), 3, "owned", m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_-]{20,}", t) if all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
        found.append(sorted(base_spans(t) + more))
        for s in found[-1]:
            owners[s[4]].add(r[2] or "")
    out = []
    for own in found:
        base = [s for s in own if s[1] < 3]
        out.append([(*s[:4], len(owners[s[4]])) for s in own if s[1] < 3 or len(owners[s[4]]) == 1 and not any(b[0] < s[3] and b[3] > s[0] for b in base)])
    return out


def test_secrets(docs, none):
    found = secrets.scan(docs, "doc_id", "text", F.concat_ws("/", "source", "lang"), F.col("source")).collect()
    want = all_spans(rows())
    assert bag((r.doc_id, tuple((s.begin, s["at"], s.kind, s.end, s.owners) for s in r.spans)) for r in found) == bag((r[0], tuple(w)) for r, w in zip(rows(), want, strict=True))
    kinds = collections.Counter(s[2] for w in want for s in w)
    assert set(kinds) == {"assign", "access", "hex", "owned"}
    assert secrets.scan(none, "doc_id", "text", F.col("source"), F.col("source")).count() == 0


def test_redact(spark, docs):
    kept = secrets.redact(docs, "text", F.concat_ws("/", "source", "lang"), F.col("source"))
    assert kept.columns == docs.columns
    want = bag()
    for r, found in zip(rows(), all_spans(rows()), strict=True):
        text, marks = r[1], [False] * len(r[1] or "")
        for begin, _, _, end, owners in found:
            if owners < secrets.EXAMPLE_OWNERS:
                marks[begin:end] = [True] * (end - begin)
        if text is not None:
            cut = [(begin, end) for begin, _, _, end, owners in sorted(found) if owners < secrets.EXAMPLE_OWNERS]
            runs = []
            for begin, end in cut:
                if runs and begin < runs[-1][1]:
                    runs[-1][1] = max(end, runs[-1][1])
                else:
                    runs.append([begin, end])
            for begin, end in reversed(runs):
                text = text[:begin] + "[SECRET]" + text[end:]
        want[r[0], text] += 1
    assert bag((r.doc_id, r.text) for r in kept.collect()) == want
    copied = spark.createDataFrame([(i, "password=example1234", f"o{i}") for i in range(3)] + [(9, "password=mine12345", "o1")], "doc_id long, text string, source string")
    assert sorted(r.text for r in secrets.redact(copied, "text", F.col("source"), F.col("source")).collect()) == ["[SECRET]", *["password=example1234"] * 3]


def test_log_bilinear(docs, none):
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    found = log_bilinear.score(docs, "doc_id", "text", held).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    out = lambda k: k is not None and zlib.crc32(str(k).encode()) % 5 == 1
    c = collections.Counter(w for r in rows() if not out(r[0]) for w in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    want = bag()
    for r in rows():
        w = tokens(r[1])
        want[r[0], out(r[0]), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)] += 1
    assert bag((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    assert all(r.score < 0 for r in found)
    assert log_bilinear.score(none, "doc_id", "text", held).count() == 0
    alone = log_bilinear.score(docs, "doc_id", "text", F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in alone)


def test_log_bilinear_is_normalised_and_rare_words_join(docs, monkeypatch):
    share = np.random.default_rng(0).dirichlet(np.ones(log_bilinear.VOCABULARY))
    far, near, normaliser = log_bilinear.Model(share).tables()
    for a, b in ((0, 0), (3, 900), (1000, 17)):
        assert abs((10.0 ** (far[a].astype(float) + near[b] - normaliser[a, b])).sum() - 1) < 1e-4
    held = F.lit(False)
    want = {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in log_bilinear.score(docs, "doc_id", "text", held).collect()}
    monkeypatch.setattr(log_bilinear, "HEAD", 3)
    assert {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in log_bilinear.score(docs, "doc_id", "text", held).collect()} == want


def test_importance(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 3 and 1, 0, "x") for i in range(30)] + [(None, 1, 0, "x"), (4, None, 0, "x"), (5, 0, 0, "x")], "doc_id long, quality int, toxic int, clean string")
    scored, condition = importance.resample(docs, "doc_id", "text", labels)
    found = scored.collect()
    assert len(found) == len(rows())
    k = round(len(rows()) * 19 / 30)  # of 30 labelled documents 20 say clean, and one of them is told otherwise too
    cut = sorted((r.score for r in found), reverse=True)[k - 1]
    assert all(r.kept == (r.score >= cut) for r in found)
    kept = docs.filter(condition)
    assert kept.columns == docs.columns and bag(r.doc_id for r in kept.collect()) == bag(r.doc_id for r in found if r.kept)
    assert importance.resample(none, "doc_id", "text", labels)[0].count() == 0
    unlabelled = importance.resample(docs, "doc_id", "text", labels.limit(0))[0]
    assert unlabelled.filter("kept").count() == len(rows())


def test_importance_grams():
    import pyarrow as pa

    bucket, text = importance.grams(pa.array(["abcde", None, "abc", "x x y", "abcd"]))
    pairs = (1 << importance.BITS) - 2
    assert collections.Counter(text[bucket < pairs].tolist()) == {0: 2, 3: 2, 4: 1}
    assert sorted(bucket[bucket >= pairs].tolist()) == [pairs, pairs + 1]
    assert bucket[0] == bucket[text == 4][0]


def test_cut_off(spark):
    r = random.Random(0)
    values = [r.randrange(-(10**9), 10**9) for _ in range(3000)] + [5] * 400
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 2, 1500, 1700, 3400):
        assert importance.cut_off(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert importance.cut_off(df, "v", 3401) is None and importance.cut_off(df, "v", 0) is None


def test_slices_and_flat():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "b" * 50, "", "cc"])], names=["t"])
    parts = [p.column(0).to_pylist() for p in common.slices([batch], 0, 4)]
    assert [x for p in parts for x in p] == batch.column(0).to_pylist() and len(parts) >= 3
    data, borders = common.flat(batch.column(0).slice(1, 4))
    assert bytes(data) == b"b" * 50 + b"cc" and borders.tolist() == [0, 0, 50, 50, 52]


def test_piece_bpe(docs, none):
    import sentencepiece

    pieces = piece_bpe.Pieces.of_file(piece_bpe.default_path())
    own = sentencepiece.SentencePieceProcessor(model_file=piece_bpe.default_path())
    found = piece_bpe.decode(piece_bpe.encode(docs, "doc_id", "text", pieces, decoded=True), "ids", pieces, "again").collect()
    want = [(r[0], tuple(own.encode(r[1] or "", add_bos=True, add_eos=True))) for r in rows()]
    assert bag((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found) == bag(want)
    assert bag((r.doc_id, r.decoded) for r in found) == bag((i, own.decode(list(ids))) for i, ids in want)
    assert all(r.again == r.decoded and r.n_tokens == len(r.ids) // 4 for r in found)
    assert piece_bpe.encode(none, "doc_id", "text", pieces, decoded=True).count() == 0


def test_piece_bpe_on_odd_texts_and_ids(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(piece_bpe, "PAIRS", 500)
    monkeypatch.setattr(piece_bpe, "TABLED", 300)
    e = piece_bpe.Encoder(piece_bpe.Pieces.of_file(piece_bpe.default_path()))
    e.memo.most = 50
    own = sentencepiece.SentencePieceProcessor(model_file=piece_bpe.default_path())
    r = random.Random(1)
    parts = ["a", "b", " ", "  ", "▁", "\t", "\n", "é", "漢", "字", "ﬁ", "\x00", "\x01", "😀", "the", "ing", "e", "t", "of ", "x" * 60]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(2000)]
    texts += [" " * n + end for n in range(40) for end in ("", "x")] + ["a" * n for n in range(80)] + ["ab" * 40_000]
    ids = e(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == own.encode(texts, add_bos=True, add_eos=True)
    assert [e.decode(i) for i in ids] == own.decode(own.encode(texts, add_bos=True, add_eos=True))
    some = [0, 1, 2, 259, 260, 29871, 3 + 0xE4, 3 + 0xB8, 3 + 0xAD]
    drawn = [[r.choice(some) if r.random() < 0.5 else r.randrange(32_000) for _ in range(r.randint(0, 12))] for _ in range(2000)]
    assert [e.decode(np.array(i, "<u4").tobytes()) for i in drawn] == [own.decode(i) for i in drawn]


def test_tokens_apart_as_merging_tells():
    """Undoing merges and merging the joint text agree, also where scores tie or parts come later than the whole."""
    r = random.Random(4)
    for trial in range(30):
        strings = {"a", "b", "c"} | {"".join(r.choice("abc") for _ in range(r.randint(2, 6))) for _ in range(40)}
        scored = tuple((i, p, float(-r.randint(0, 20 if trial % 2 else 10_000)) if len(p) > 1 else -20_000.0) for i, p in enumerate(sorted(strings), 1))
        m = piece_bpe.Merges(scored)
        real = [i for i, _, _ in scored if m.rank[i] is not None]
        for a, b in itertools.product(real, real):
            assert m.apart(a, b) == (m.merge(m.text[a] + m.text[b])[0] == [m.text[a], m.text[b]])


VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, x string, `key` string, width string, pivots string, `a.b` string"


def vector_rows(width=6, n=150):
    r = np.random.default_rng(5)
    mid = r.normal(size=(7, width))
    out = [(i, (mid[i % 7] + 0.3 * r.normal(size=width)).astype(np.float32).tolist()) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    out += [(1000, None), (1001, []), (1002, [nan] * width), (1003, [1.0, None] + [0.0] * (width - 2)), (1004, [inf] + [0.0] * (width - 1))]
    out += [(1005, [0.0] * width), (1006, [-0.0] * width), (1007, [1.0] * (width - 1)), (1008, [2.0] * (width + 1)), (None, out[4][1]), (None, out[5][1])]
    out += [out[3], out[3], (-4, out[3][1]), (7, [5.0] * width)] + [(2000 + i, out[0][1]) for i in range(60)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(*row, None, *"abcde") for row in rows], VECTOR_SCHEMA).repartition(5)


def whole(rows, scale, width):
    """The rows that are kept, with their integers."""
    good = [(i, v) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    return [(i, tuple(math.floor(scale * x) for x in v)) for i, v in good]


def plain_clusters(kept, k, rounds):
    def near(x, centroids):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centroids))

    mark = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [x for _, x in sorted(kept, key=mark)[:k]]
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, x in kept:
            own[near(x, centroids)[1]].append(x)
        centroids = [tuple(sum(c) // len(own[n]) for c in zip(*own[n], strict=True)) if n in own else c for n, c in enumerate(centroids)]
    dealt = [(i, *near(x, centroids)) for i, x in kept]
    inertia = collections.Counter()
    for _, d, n in dealt:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, d, n in dealt]


@pytest.mark.parametrize(("k", "scale"), [(5, 64), (16, 64), (4, 1 << 40), (400, 2)])
def test_pivot_clusters(spark, k, scale):
    """Also with integers too large for 64-bit squares, and with fewer vectors than centroids."""
    found, _ = pivot_clusters.cluster(vectors(spark, vector_rows()), "vec_id", "embedding", width=6, scale=scale, k=k, rounds=3, seed=1)
    want = plain_clusters(whole(vector_rows(), scale, 6), k, 3)
    long = lambda v: v if v < 1 << 63 else None
    assert bag(map(tuple, found.collect())) == bag((i, n, long(d), long(c), long(t), h) for i, n, d, c, t, h in want)


def test_pivots_rule_centroids_out():
    r = np.random.default_rng(2)
    x = np.concatenate([100 * r.integers(-9, 9, 8) + r.integers(-9, 9, (50, 8)) for _ in range(16)])
    c = pivot_clusters.Centroids(x[::50].tolist(), (x[::50] + 1).tolist())
    label, distance, taken = c.nearest(x, c.table(x))
    every = ((x[:, None] - np.array(c.rows)[None]) ** 2).sum(axis=2)
    assert (label == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all() and taken < 3 * len(x)


def test_pivot_clusters_of_nothing(spark):
    for rows in ([], [(1, None)], [(None, [1.0] * 6), (None, [1.0] * 6)]):
        found, _ = pivot_clusters.cluster(vectors(spark, rows), "vec_id", "embedding", width=6)
        assert bag(map(tuple, found.collect())) == bag(plain_clusters(whole(rows, 64, 6), 16, 3))
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def plain_whitening(kept, components):
    from fractions import Fraction

    fit = sorted({x for _, x in kept})
    n, d = len(fit), len(fit[0])
    total = [sum(x[i] for x in fit) for i in range(d)]
    cov = np.array([[float(sum((n * x[i] - total[i]) * (n * x[j] - total[j]) for x in fit) / Fraction(n) ** 3) for j in range(d)] for i in range(d)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    white = [(i, x, [float(a - Fraction(s, n)) for a, s in zip(x, total, strict=True)]) for i, x in kept]
    with np.errstate(divide="ignore", invalid="ignore"):
        return n, cov, e, [(i, sum((n * a - s) ** 2 for a, s in zip(x, total, strict=True)), np.array(z) @ v / np.sqrt(e)) for i, x, z in white]


@pytest.mark.parametrize("scale", [256, 1 << 40])
def test_whitening(spark, scale):
    found, model = whitening.whiten(vectors(spark, vector_rows()), "vec_id", "embedding", components=4, scale=scale)
    n, cov, e, want = plain_whitening(whole(vector_rows(), scale, 6), 4)
    found = found.collect()
    assert len(found) == 4 * len(want) and {r.n for r in found} == {n}
    assert np.allclose(model.values[:4], e, rtol=1e-12)
    assert all(math.isclose(r.explained, e[r.component - 1] / np.trace(cov), rel_tol=1e-12) and r.identity_error < 1e-9 for r in found)
    kept = lambda v: v if v < 10**38 else None
    assert bag((r.vec_id, r.component, r.deviation and int(r.deviation)) for r in found) == bag((i, c, kept(d)) for i, d, _ in want for c in (1, 2, 3, 4))
    by_key = {(r.vec_id, r.component): r.whitened for r in found if r.vec_id not in (None, 7)}
    sign = [np.sign(by_key[0, c] * want[0][2][c - 1]) for c in (1, 2, 3, 4)]
    assert all(math.isclose(by_key[i, c], sign[c - 1] * w[c - 1], rel_tol=1e-8, abs_tol=1e-8) for i, _, w in want if i not in (None, 7) for c in (1, 2, 3, 4))


def test_whitening_of_little(spark):
    none, model = whitening.whiten(vectors(spark, [(1, None), (2, [])]), "vec_id", "embedding")
    assert model is None and none.count() == 0
    found, _ = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0, 3.0])]), "vec_id", "embedding")
    assert sorted((r.vec_id, r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in found.collect()) == [
        (i, c, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    ]
    line, _ = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(9)]), "vec_id", "embedding")
    assert all((r.whitened is None) == (r.component > 1) and r.identity_error < 1e-9 for r in line.collect())


def test_packed_vectors():
    for limit in (1 << 7, 1 << 15, 1 << 20, 1 << 31, 1 << 62):
        x = np.random.default_rng(1).integers(-limit, limit, (50, 3))
        x[0] = [limit - 1, -limit, 0]
        raw = whole_vectors.packed(x)
        assert (whole_vectors.unpacked(common.pa.array(raw, common.pa.binary()), 3) == x).all()
    assert {len(v) for v in whole_vectors.packed(np.array([[-(1 << 15)], [1 << 15], [-(1 << 15) - 1], [1 << 31]]))} == {2, 4, 8}


def test_importance_against_plain_counts(spark, docs):
    """Counts, mean log ratio and noise by plain code."""
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(50)], "doc_id long, quality int, toxic int")
    found = importance.resample(docs, "doc_id", "text", labels)[0].collect()
    whole = (1 << 64) - 1

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & whole
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & whole
        return x ^ (x >> 31)

    def grams(text):
        raw = (text or "").encode()
        out = [mixed(int.from_bytes(raw[i : i + 4], "big") + 1) >> (64 - importance.BITS) for i in range(len(raw) - 3)]
        last = (1 << importance.BITS) - 2
        words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        return [b if b < last else 0 for b in out] + [last + (a == b) for a, b in itertools.pairwise(words)]

    raw, target = collections.Counter(), collections.Counter()
    for r in rows():
        raw.update(grams(r[1]))
        if r[0] is not None and 0 <= r[0] < 50 and r[0] % 3 and r[0] % 7:
            target.update(grams(r[1]))
    share = sum(target.values()) / sum(raw.values())
    hashes = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64(F.lit(42), "doc_id")).collect()}
    want = collections.defaultdict(list)
    for r in rows():
        own = grams(r[1])
        ratio = sum(math.log((target[b] + 1) / (raw[b] * share + 1)) for b in own) / max(1, len(own))
        u = ((hashes[r[0]] & ((1 << 52) - 1)) + 0.5) / (1 << 52)
        want[r[0]].append((ratio, (1000 * ratio - math.log(-math.log(u))) * 1e6))
    assert len(found) == len(rows())
    for r in found:
        assert any(abs(r.log_ratio - a) < 1e-5 and abs(r.score - b) < 2e4 for a, b in want[r.doc_id])


def test_memo_of_stated_bytes(monkeypatch):
    """A memo's generations stay below the bytes that its caller names, and the pipeline names fewer than the default."""
    import corpus_pipeline
    from tabprep.llm import byte_bpe

    memo = byte_bpe.Memo(lambda s: b"1234", most_bytes=2000)
    for i in range(200):
        memo[str(i)]
        assert memo.held <= 2000 and len(memo) + len(memo.older) <= 2 * 2000 // byte_bpe.ENTRY_BYTES
    named = []
    monkeypatch.setattr(byte_bpe, "encode", lambda *a, held_bytes=None, **k: named.append(held_bytes) or a[0])
    with pytest.raises(Exception):
        corpus_pipeline.tokens(None, None, "")  # the stub has no columns to select
    assert named == [corpus_pipeline.MEMO_BYTES] and 2 * corpus_pipeline.MEMO_BYTES < byte_bpe.HELD_BYTES


def test_sums_by_id_keep_the_order_of_rows():
    """Ids are sorted by radix: 16 bits, which hold the whole vocabulary, and equal ones in their order."""
    from tabprep.llm import log_bilinear

    assert log_bilinear.VOCABULARY <= 1 << 16
    kinds = []
    r = np.random.default_rng(1)
    ids, rows = r.integers(0, log_bilinear.VOCABULARY, 5000), r.normal(size=(5000, 3)).astype(np.float32)

    class Watched(np.ndarray):
        def argsort(self, *a, **k):
            kinds.append(self.dtype)
            return np.asarray(self).argsort(*a, **k)

    found = log_bilinear._summed(ids.view(Watched), rows)
    want = np.zeros((log_bilinear.VOCABULARY, 3))
    np.add.at(want, ids, rows)
    assert np.allclose(found, want, atol=1e-4) and kinds == [np.dtype(np.uint16)]


def test_plain_words_need_no_splitter():
    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    worker = token_files._Worker(token_files.Tokenizer.of_file(path, end=0))

    class Watched:
        def __init__(self, model):
            self.whole, self.model, self.given = model, model.model, []

        def encode_batch_fast(self, texts, add_special_tokens):
            self.given += texts
            return self.whole.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    worker.model = Watched(worker.model)
    plain = lambda t: np.array(library.encode(t, add_special_tokens=False).ids, worker.kind).tobytes()
    texts = ["a Vvorrd, Zürichh ñandúes Vvorrd###", "a łódź Vvorrd"]
    assert worker(texts) == [plain(t) for t in texts]
    assert sorted(worker.model.given) == ["###", ",", "a"]
    # every character up to the last old letter and some beyond, inside, before and behind a word
    texts = [f"a {c}xy xy{c} x{c}y{c} {c}" for c in map(chr, range(0x300))]
    assert worker(texts) == [plain(t) for t in texts]
    for part in (" " + "ab cd", " ab  cd", " ab ", "ab", " ", "", " a×b", " a\u0250", " don't", " ab\n"):
        assert worker.ids(part).tobytes() == plain(part), part


def test_pieces_follow_from_their_parts(monkeypatch):
    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    told = token_files.Tokenizer.of_file(path, end=0)
    worker = token_files._Worker(told)
    given = []
    ids = worker.ids
    monkeypatch.setattr(worker, "ids", lambda text: given.append(text) or ids(text))
    worker(["a Vvorrd Lliine Ssttart wword"])
    assert len(given) == 2  # the first word, and the others in one go
    given.clear()
    texts = ["a Vvorrd### wword.\nSsttart Lliine,***", "a wword&&&\nSsttart!!\nSsttart", "a Lliine###\nSsttart"]
    got = worker(texts)
    # only marks and what starts a line were new: no word behind a space
    assert not any(x in " ".join(given) for x in (" Vvorrd", " wword", " Lliine"))
    plain = lambda t: np.array(library.encode(t, add_special_tokens=False).ids, worker.kind).tobytes()
    assert got == [plain(t) for t in texts]
    r = random.Random(5)
    bits = ["the", "Zürich", "naïve", "'s", "'", "don't", "\n", "\n\n", "\r", "\t", "###", ".", ",\n", "12", "東京", "ſ", "͸", "\x1c", "\x85", " ", "_", "`", "é", "x" * 130, " ", " ", " "]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    monkeypatch.setattr(worker.later, "most", 500)
    monkeypatch.setattr(worker.first, "most", 50)
    for at in range(0, len(texts), 200):
        part = texts[at : at + 200]
        for t, x in zip(part, worker(part), strict=True):
            assert x == plain(t), t
