"""Every operator on texts against a plain version, on the driver's smallest table and on odd rows."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from furrow import session
from furrow.llm import byte_bpe, language_id, mixing, quality_classifier, quality_rules, queries, simhash, stats, substring_dedup, token_files
from furrow.llm import text as T

DIR = "/root/testdata/sf0.001"
VOCABULARY, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["table", "odd"])
def docs(request, spark, odd):
    return spark.read.parquet(f"{DIR}/documents.parquet") if request.param == "table" else odd


SPOKEN = "the of and to in that is was for on with as his they at be this from have or by one had not but what all were when".split()


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def multiset(values):
    return Counter(tuple(v) for v in values)


@pytest.mark.parametrize("chunk", [byte_bpe.CHUNK, 97])
def test_byte_bpe_is_the_librarys_and_decodes(docs, chunk):
    encoding = byte_bpe.Codec(VOCABULARY, PATTERN).encoding
    want = []
    for i, t in rows(docs):
        ids = encoding.encode_ordinary(t or "")
        want.append((i, len(ids), struct.pack(f"<{len(ids)}I", *ids), (t or "").encode()))
    done = byte_bpe.encode(docs, VOCABULARY, PATTERN, chunk=chunk, decoded=True)
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in done.collect()]
    assert multiset(got) == multiset(want)
    again = byte_bpe.decode(done.select("doc_id", "ids"), VOCABULARY, PATTERN).select(F.sha2("decoded", 256)).collect()
    assert Counter(r[0] for r in again) == Counter(hashlib.sha256(w[3]).hexdigest() for w in want)


def test_pretokens_agree_on_every_code_point():
    c = byte_bpe.Codec(VOCABULARY, PATTERN)
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    assert np.frombuffer(c.encode(every.encode()), "<u4").tolist() == c.encoding.encode_ordinary(every)


def test_token_files_hold_the_librarys_ids_in_order(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    to = f"{session.scratch(spark)}/tokens-{id(docs)}-{np.random.randint(1 << 30)}"
    token_files.write(docs, to, public_tokenizers.path("word_bpe_49k.json"), 1, shard_ids=5000)
    got = sorted(token_files.read(spark, to).collect(), key=lambda r: r.start)
    want = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows(docs)]
    assert multiset((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == multiset((i, len(x), zlib.crc32(struct.pack(f"<{len(x)}I", *x))) for i, x in want)
    place, last = 0, None
    for r in got:
        assert r.start == place and (last is None or (r.doc_id is not None and r.doc_id >= last))
        place, last = place + r.n_tokens, r.doc_id if r.doc_id is not None else last
    shard = spark.read.parquet(to).orderBy("part", "seq").first()
    ef, ids = token_files.unpack(shard.body)
    assert all(len(token_files.open_document(shard.body, i)) == ef.select(i + 1) - ef.select(i) for i in range(shard.n_docs)) and len(ids) == shard.n_tokens


class Counted:
    """A tokenizer that counts the words it is given."""

    def __init__(self, inner, seen):
        self.inner, self.seen = inner, seen

    def encode_batch_fast(self, texts, **options):
        self.seen += [w for t in texts for w in t.split()]
        return self.inner.encode_batch_fast(texts, **options)


def test_a_word_is_encoded_once_whatever_marks_follow():
    ids = token_files.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    library, seen = ids.tokenizer, []
    ids.tokenizer, ids.letters = Counted(ids.tokenizer, seen), Counted(ids.letters, seen)
    words, ends = [x + "é" * (k % 2) for k, x in enumerate(SPOKEN)], ["", ",", ".", "!?", "***", "%%%", "...", ")"]
    for e in ends:
        t = " ".join(x + e for x in words)
        raw = np.frombuffer(t.encode(), np.uint8)
        assert ids(raw, np.array([0, len(raw)]))[0].tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(seen) <= len(words) + len(ends)


@pytest.mark.parametrize("hashes", ["own", "by length"])
@pytest.mark.parametrize("held", [token_files.HELD, 40])
def test_words_at_marks_are_the_librarys(monkeypatch, held, hashes):
    monkeypatch.setattr(token_files, "HELD", held)
    if hashes == "by length":
        monkeypatch.setattr(T, "word_hashes", lambda data, w, *_: (w.end - w.start).astype(np.uint64))
    ids, g = token_files.WordIds(public_tokenizers.path("word_bpe_49k.json")), np.random.default_rng(5)
    pieces = [*"aeszdmkSÉÀéßÿñ×÷,.;:!?#*$%&|<>()'\"-_019\u0301\u0338\u212aİΣσĳªµ\u00a0\u2003漢", "'s", "'re", "'ll", "</w>", "<|endoftext|>", "." * 15, "!" * 16, "#" * 17, "?" * 40, " ", " ", "\n"]
    for _ in range(12):
        texts = ["".join(g.choice(pieces, g.integers(0, 60))) for _ in range(25)]
        raw = [t.encode() for t in texts]
        got, count = ids(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [x.tolist() for x in np.split(got, np.cumsum(count)[:-1])] == [ids.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [0, 5, 5, 1000], list(range(0, 5000, 3)), [0, 1 << 40]])
def test_elias_fano(values):
    v = np.array(values, np.int64)
    ef = token_files.EliasFano.of(v)
    assert ef.all().tolist() == values and [ef.select(i) for i in range(len(values))] == values


def brute_windows(pairs, size=20):
    seen, out = set(), []
    ordered = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[2]))
    for i, t, _ in ordered:
        words, gone = WORD.findall(t or ""), set()
        for j in range(len(words) - size + 1):
            key = tuple(words[j : j + size])
            if key in seen:
                gone |= set(range(j, j + size))
            seen.add(key)
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(w for j, w in enumerate(words) if j not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 22, 3000])
def test_substring_dedup_is_brute_force(docs, block_bytes):
    pairs = [(r.doc_id, r.text, r.tie) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect()]
    done = substring_dedup.dedup(docs, block_bytes=block_bytes)
    got = done.select("doc_id", "n_words", "n_removed", queries.words_hash(F.coalesce("text", F.lit(""))).alias("h")).collect()
    assert multiset(got) == multiset(brute_windows(pairs))
    untouched = done.where("n_removed = 0").select("text").collect()
    assert Counter(r.text for r in untouched) - Counter(t for _, t, _ in pairs) == Counter()


@pytest.mark.parametrize("size,base", [(20, 5), (7, 3), (3, 5)])
def test_ladder(size, base):
    lengths = substring_dedup.ladder(size, base)
    assert lengths[-1] == size and all(b <= 2 * a for a, b in zip(lengths, lengths[1:]))


def test_counts_of_the_quality_rules(docs):
    model = quality_rules.grow(np.zeros((0, len(stats.SHARES))), np.zeros(0, int), np.zeros(len(stats.SHARES)))
    want = []
    for i, t in rows(docs):
        t = t or ""
        words = WORD.findall(t)
        windows = Counter(tuple(words[j : j + 5]) for j in range(len(words) - 4))
        again = {j + k for j in range(len(words) - 4) if windows[tuple(words[j : j + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
        want.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed))
    got = quality_rules.judge(docs, model).select("doc_id", *stats.COUNTS, "base_failed").collect()
    assert multiset(got) == multiset(want)


def test_trees_keep_monotone_features_and_learn():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.2)).astype(int)
    flip = rng.random(3000) < 0.1
    model = quality_rules.grow(x, np.where(flip, 1 - y, y), np.array([-1, 0, 0, 1]))
    assert ((model.score(x) > 0.5) == y).mean() > 0.93
    for f, sign in ((0, -1), (3, 1)):
        line = np.tile(x[:50], (20, 1))  # one feature varies at a time
        line[:, f] = np.repeat(np.linspace(0, 1, 20), 50)
        s = model.score(line).reshape(20, 50)
        assert (sign * np.diff(s, axis=0) >= -1e-12).all()


def test_learnt_quality_on_the_held_out_fold(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    known = labels.join(docs, "doc_id").where(T.held_out(F.col("doc_id")))
    for judged in (
        quality_classifier.classify(known, quality_classifier.train(docs, labels), keep=("quality",)).withColumn("good", F.col("predicted") == 1),
        quality_rules.judge(known, quality_rules.train(docs, labels)).withColumn("good", F.col("score") >= 0.3).join(labels, "doc_id"),
    ):
        r = judged.groupBy("quality").agg(F.avg(F.col("good").cast("int")).alias("a")).collect()
        share = {x.quality: x.a for x in r}
        assert share[1] > 0.99 and share[0] < 0.05


def test_classifier_on_odd_rows(odd):
    got = quality_classifier.classify(odd, quality_classifier.fit(np.zeros((0, 12)), np.zeros(0, int)), keep=("text", "lang"))
    assert got.count() == odd.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert Counter(r.text for r in got.collect()) == Counter(t for _, t in rows(odd))


def brute_fingerprint(t):
    words = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, most=2):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most and label[i] != label[j]:
                a, b = min(label[i], label[j]), max(label[i], label[j])
                label = [a if x == b else x for x in label]
    return label


def test_simhash_is_brute_force(docs):
    pairs = rows(docs.where("doc_id IS NOT NULL"))
    fps = [brute_fingerprint(t) for _, t in pairs]
    label = brute_components(fps)
    least = {}
    for k, (i, _) in zip(label, pairs):
        least[k] = min(least.get(k, i), i)
    got = simhash.near_dedup(docs.where("doc_id IS NOT NULL")).select("doc_id", simhash.hex16(F.col("fp")).alias("h"), "component_id").collect()
    assert multiset(got) == multiset((i, f"{f:016x}", least[k]) for (i, _), f, k in zip(pairs, fps, label))
    assert simhash.near_dedup(docs).count() == docs.count()


def test_gray_index_finds_every_pair():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [int(b) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for b in base[:150]]
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    index = simhash.GrayIndex(fps)
    q, node = index.near(index.fps, 2)
    got = {(int(a), int(b)) for a, b in zip(q, node)}
    d = np.bitwise_count(index.fps[:, None] ^ index.fps[None])
    assert got == set(zip(*map(lambda v: v.tolist(), np.nonzero(d <= 2))))
    ranks = simhash.gray_rank(np.arange(8, dtype=np.uint64))
    order = np.argsort(ranks)
    assert all(bin(int(a) ^ int(b)).count("1") == 1 for a, b in zip(order, order[1:]))


def test_fields_and_second_cut_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 8)
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    fps = np.unique(np.concatenate([centre, *(c ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for c in centre)]))
    links = simhash.near_links(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")).collect()
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    label = list(range(len(fps)))
    for r in links:
        a, b = label[at[r.a]], label[at[r.b]]
        label = [min(a, b) if x == max(a, b) else x for x in label]
    want = brute_components([int(x) for x in fps])
    pairs = lambda v: {(i, j) for i in range(len(v)) for j in range(i) if v[i] == v[j]}
    assert pairs(label) == pairs(want)


def test_language_held_out_and_undetermined(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs)
    r = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(T.held_out(F.col("doc_id")))
    assert r.where("lang = lang_pred").count() > 0.97 * r.count()
    got = {(x.doc_id, x.lang_pred) for x in language_id.identify(odd, model).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (12, "und")} <= got and language_id.identify(odd, model).where("score < 0 OR score > 1").count() == 0
    assert language_id.identify(odd, language_id.build({})).where("lang_pred <> 'und'").count() == 0


def plain_phrases(learnt, raw):
    """Greedy longest pieces of raw that occur in learnt, one after another."""
    fold = lambda x: re.sub(rb"[\t-\r]", b" ", re.sub(rb"[0-9]", b"0", x.lower()))
    learnt, raw, at, n = fold(learnt), fold(raw), 0, 0
    while at < len(raw):
        size = 1
        while at + size < len(raw) and raw[at : at + size + 1] in learnt:
            size += 1
        at, n = at + size, n + 1
    return n


@pytest.mark.parametrize("segment", [language_id.SEGMENT, 64, 7, 1])
def test_phrases_are_those_of_a_plain_cross_parse(docs, segment):
    raws = [(t or "").encode()[:20_000] for _, t in rows(docs)][-80:] + [b"a" * 9000, b"", b"\xff\xfe" * 50, b"zq" * 3000, bytes(range(256)) * 3]
    texts = {"a": b"".join(raws[:9]), "b": b"zqz the of and", "c": b"", "d": bytes(range(128))}
    data, offsets = np.frombuffer(b"".join(raws), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raws])])
    got = language_id.build(texts).phrases(data, offsets, segment)
    assert got.tolist() == [[plain_phrases(texts[k], x) for k in sorted(texts)] for x in raws]


def test_languages_of_whole_table_against_a_plain_parse(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    texts = language_id.sample(docs)
    known = {(r.lang, r.text) for r in docs.where(~T.held_out(F.col("doc_id"))).collect()}
    assert all(any(texts[k].startswith(t.encode()) for lang, t in known if lang == k and t) for k in texts) and all(len(v) < 2 * language_id.SAMPLE_BYTES for v in texts.values())
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, language_id.build(texts)).collect()}
    for i, t in rows(docs):
        raw = (t or "").encode()
        cost = [plain_phrases(texts[k], raw) * np.log2(len(texts[k])) for k in sorted(texts)]
        assert got[i] == (sorted(texts)[int(np.argmin(cost))] if any(c.isalpha() for c in t or "") else "und")


def test_language_sample_is_whole_and_equal_for_each(spark):
    words = lambda k, n: " ".join(f"{'abcdefgh'[(k * 7 + i) % 8]}{i % 5}" for i in range(n))
    rows_ = [(i, words(i, 30), f"l{i % 30:02d}") for i in range(3000)] + [(9000 + i, words(i, 30_000 + i), "long") for i in range(5)] + [(9100 + i, words(1, 20), "copies") for i in range(700)] + [(9999, words(2, 9), "twice")] * 3
    texts = language_id.sample(spark.createDataFrame(rows_, "doc_id long, text string, lang string"), docs_each=20, sample_bytes=1500)
    whole = {lang: {t for _, t, k in rows_ if k == lang} for lang in texts}
    assert set(texts) == {k for _, _, k in rows_} - ({"twice"} if "twice" not in texts else set())
    assert all(set(v.decode().split("\n")) <= whole[k] for k, v in texts.items())
    assert len(texts["long"].split(b"\n")) == 1 and all(1500 <= len(texts[f"l{k:02d}"]) <= 1700 for k in range(30))


def test_suffix_automaton_cross_parse():
    model = language_id.build({"a": b"abcabcabd", "b": b"zzzz"})
    data = np.frombuffer(b"abcabdabc", np.uint8)
    phrases = model.phrases(data, np.array([0, 9]))
    assert phrases[0].tolist() == [2, 9]  # abcabd|abc; no letter of b: a phrase for each


def test_mixing_adds_up(docs):
    m = mixing.mix(docs).collect()
    size = Counter()
    for _, t in rows(docs):
        size["total"] += len(WORD.findall(t or ""))
    assert len(m) == docs.count() and sum(r["size"] for r in m) == size["total"]
    assert all(0 <= r.taken <= 3 * r["size"] for r in m) and all(sum((c["to"] - c["from"]) * c["times"] for c in r.cuts) == r.taken for r in m)
    assert multiset((r.doc_id, r.tie, r.taken) for r in m) == multiset((r.doc_id, r.tie, r.taken) for r in mixing.mix(docs.repartition(5)).collect())


def test_mixing_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id")
    for r in m.groupBy("source").agg(F.sum("taken").alias("k"), F.first("target").alias("t")).collect():
        assert abs(r.k - r.t) <= 0.01 * r.t
    done = mixing.render(docs, mixing.mix(docs), docs.columns)
    words = done.select(F.size(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).alias("n")).agg(F.sum("n")).first()[0]
    assert words == m.agg(F.sum("taken")).first()[0] and done.columns == docs.columns


def test_mixing_meets_targets_of_small_sources_and_of_many_shards(spark):
    """Blocks of 4,096 words: a source of a few words, one with a few words in each shard, and large ones that do not stop."""
    sizes = {"a few": {3: 7}, "b short": {s: 400 for s in range(234)}, "c one block": {0: 5000}, "d large": {s: 150_000 + 7 * s for s in range(234)}, "e uneven": {s: 1 + 1700 * (s % 97) for s in range(234)}}
    shards = spark.createDataFrame([(k, s, w) for k, v in sizes.items() for s, w in v.items()], "_source string, shard long, words long")
    taken, target, blocks = Counter(), {}, set()
    for r in mixing.plan(shards).collect():
        often = mixing.times(r.words, r.block, r.quota, 11, r.shard)
        assert often.max() <= 3
        taken[r._s] += mixing.take(often, r.words, 0, r.words)[0]
        target[r._s] = r.target
        blocks.add(r.block)
    assert all(taken[k] == 3 * sum(sizes[k].values()) == target[k] for k in ("a few", "b short", "c one block"))
    assert all(abs(taken[k] - target[k]) <= max(blocks) for k in ("d large", "e uneven")) and min(blocks) > 1000


def test_mixing_takes_all_of_a_small_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 20)
    monkeypatch.setattr(mixing, "BLOCKS_A_SOURCE", 8)
    rows = [(i, "w " * (30 + i % 50), "large") for i in range(400)] + [(1000 + i, "x y", "small") for i in range(40)] + [(2000, "z", "one")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(r.taken == 3 * r["size"] for r in got if r.doc_id >= 1000)
    large = [r for r in got if r.doc_id < 1000]
    assert abs(sum(r.taken for r in large) - large[0].target) <= 1000 and all(0 <= r.taken <= 3 * r["size"] for r in large)


def test_sainte_lague_gives_each_seat_to_the_highest_quotient():
    for seed in range(40):
        g = np.random.default_rng(seed)
        n = int(g.integers(1, 8))
        w, c, seats = g.integers(0, 5, n).astype(float), g.integers(0, 40, n), int(g.integers(0, 120))
        want = np.zeros(n, int)
        for _ in range(min(seats, int(c[w > 0].sum()))):
            q = np.where((want < c) & (w > 0), w / (2 * want + 1), -1)
            want[int(np.argmax(q))] += 1
        got = mixing.sainte_lague(w, c, seats)
        assert got.sum() == want.sum() and sorted(np.round(w / (2 * got + 1), 9)) == sorted(np.round(w / (2 * want + 1), 9))


def test_water_filling_stops_at_caps():
    out = mixing.water_fill([1, 2, 3], [3, 300, 300], 120)
    assert out[0] == 3 and out.sum() == pytest.approx(120) and out[2] / out[1] == pytest.approx(1.5)


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert byte_bpe.encode(none, VOCABULARY, PATTERN).count() == 0 and substring_dedup.dedup(none).count() == 0
    assert simhash.near_dedup(none).count() == 0 and mixing.mix(none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.judge(none, quality_rules.train(none, labels)).count() == 0
    assert quality_classifier.classify(odd, quality_classifier.train(none, labels)).count() == odd.count()
    assert language_id.identify(none, language_id.train(none)).count() == 0
    to = f"{session.scratch(spark)}/tokens-none-{np.random.randint(1 << 30)}"
    token_files.write(none, to, public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.read(spark, to).count() == 0


def alike():
    """Two words of 1,024 letters that every polynomial hash modulo 2**64 takes for one."""
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - x for x in bits]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def test_words_are_told_apart_by_their_bytes(spark):
    a, b = alike()
    rest = [f"w{i}" for i in range(40)]
    texts = {1: " ".join([a, *rest[:19]]), 2: " ".join([b, *rest[:19]]), 3: " ".join([a, "x", "y", "z", "u", b, "x", "y", "z", "u", *rest]), 4: "\x00 \x00\x00 " + " ".join(rest[20:])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in substring_dedup.dedup(df).collect()}
    assert removed == {i: n for i, _, n, _ in brute_windows([(i, t, 0) for i, t in texts.items()])} and removed[2] == 0
    model = quality_rules.grow(np.zeros((0, len(stats.SHARES))), np.zeros(0, int), np.zeros(len(stats.SHARES)))
    assert {r.doc_id: r.n_repeat_words for r in quality_rules.judge(df, model).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = token_files.word_ids(public_tokenizers.path("word_bpe_49k.json"))
    for t in (texts[1], texts[2], a + " " + b):
        raw = np.frombuffer(t.encode(), np.uint8)
        assert ids(raw, np.array([0, len(raw)]))[0].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_words_of_one_hash_are_compared(monkeypatch):
    monkeypatch.setattr(T, "word_hashes", lambda data, w, *_: (w.end - w.start).astype(np.uint64))
    raw = np.frombuffer(b"ab cd ab abcdefghijk abcdefghijl cd abcdefghijk", np.uint8)
    ids, first = T.word_ids(raw, T.words(raw, np.array([0, len(raw)])))
    assert ids.tolist() == [0, 1, 0, 2, 3, 1, 2] and first.tolist() == [0, 1, 3, 4]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 20])
def test_run_ids_number_runs(size):
    x = np.random.default_rng(size).integers(0, 3, 400)
    seen = {}
    want = [seen.setdefault(tuple(x[i : i + size]), len(seen)) for i in range(len(x) - size + 1)]
    got = T.run_ids(x, size).tolist()
    assert len(got) == len(want) and len(set(zip(got, want))) == len(set(got)) == len(seen)


SCRIPTS = {"han": "汉字没有空格的长文字", "han with marks": "汉字，没有。空格", "kana": "ひらがなカタカナ", "arabic": "نص عربي، طويل", "thai": "ภาษาไทยไม่มีช่องว่าง", "cyrillic": "русский текст. ", "devanagari": "हिन्दी पाठ। "}


@pytest.mark.parametrize("script", SCRIPTS)
def test_chunks_of_every_script_stay_linear(script):
    c, english = byte_bpe.Codec(VOCABULARY, PATTERN), " and then a little English, it's said.\n"
    for text in (SCRIPTS[script] * (60_000 // len(SCRIPTS[script])), (SCRIPTS[script] * 300 + english) * 20, SCRIPTS[script] * 4000 + english * 900):
        spans = byte_bpe.chunks(text, 1000)
        assert sum(z - a for a, z in spans) <= 1.5 * len(text) and spans[0][0] == 0 and spans[-1][1] == len(text)
        ids, head_to, meet = [], -1, -1
        for k, (a, z) in enumerate(spans):
            after = spans[k + 1][0] if k + 1 < len(spans) else -1
            found = byte_bpe.encode_chunk(c, text[a:z], a, after, head_to, False)
            skip = int(found[3][np.searchsorted(found[2], meet)]) if meet >= 0 else 0
            ids += np.frombuffer(found[1], "<u4").tolist()[skip:]
            meet, head_to = found[0], z
        assert ids == c.encoding.encode_ordinary(text)


def plain_shares(t):
    """The statistics of one text, word by word."""
    words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    chars, n = sum(map(len, words)), len(words)
    windows = Counter(tuple(words[j : j + 5]) for j in range(n - 4))
    again = {j + k for j in range(n - 4) if windows[tuple(words[j : j + 5])] > 1 for k in range(5)}
    letters = sum(1 for b in t.encode() if chr(b).isascii() and chr(b).isalpha() or b >= 0xC3)
    some, total, lots = max(n, 1), max(chars, 1), max(len(lines), 1)
    count = lambda pattern: len(re.findall(pattern, t))
    return [
        np.log1p(n), chars / some, count(r"[#*$%&|<>]") / total, (len(lines) - len(set(lines))) / lots, len(again) / some, len(set(words)) / some,
        sum(a == b for a, b in zip(words, words[1:])) / some, count("[A-Z]") / max(letters, 1), sum(w.endswith("!") for w in words) / some,
        count("[0-9]") / total, count("[!?.,;:]") / total, np.log1p(n / lots),
    ]


def test_scores_against_plain_trees_and_a_plain_ranker(spark, docs):
    known = spark.read.parquet(f"{DIR}/documents.parquet")
    x, y = stats.labelled_sample(known, spark.read.parquet(f"{DIR}/labels.parquet"), "quality", 20_000)
    plain = {i: np.array(plain_shares(t)) for i, t in rows(known) if t is not None}
    held = {r.doc_id for r in known.where(T.held_out(F.col("doc_id"))).select("doc_id").collect()}
    labels = spark.read.parquet(f"{DIR}/labels.parquet").collect()
    want = sorted((*plain[r.doc_id].round(9), r.quality) for r in labels if r.doc_id in plain and r.doc_id not in held)
    assert np.allclose(sorted((*a.round(9), b) for a, b in zip(x, y)), want)
    trees, ranker = quality_rules.grow(x, y, np.array([quality_rules.MONOTONE.get(k, 0) for k in stats.SHARES])), quality_classifier.fit(x, y)

    def descend(v):
        total = trees.base
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if v[trees.feature[at]] <= trees.limit[at] else trees.right[at]
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    def rank(v):
        shares = np.clip(v[2:11], 0, 1)
        f = [*v, *np.sqrt(shares), *(shares > 0.03), *(shares > 0.15), *(shares > 0.4)]
        raw = sum(w * min(6, max(-6, (a - m) / s)) for a, m, s, w in zip(f, ranker.mean, ranker.scale, ranker.weight))
        return 1 / (1 + np.exp(-np.clip((raw - ranker.cut) / ranker.spread + np.log(0.3 / 0.7), -30, 30)))

    by_text = {t or "": (descend(v := np.array(plain_shares(t or ""))), rank(v)) for _, t in rows(docs)}
    order = lambda values: sorted(values, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    judged = order((r.doc_id, r.score) for r in quality_rules.judge(docs, trees).collect())
    assert np.allclose([s for _, s in judged], [s for _, s in order((i, by_text[t or ""][0]) for i, t in rows(docs))], atol=1e-9)
    for r in quality_rules.judge(docs, trees).collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed and r.score >= 0.3)
    classified = quality_classifier.classify(docs, ranker).collect()
    assert np.allclose([s for _, s in order((r.doc_id, r.score) for r in classified)], [s for _, s in order((i, by_text[t or ""][1]) for i, t in rows(docs))], atol=1e-9)
    assert all(r.predicted == (r.score >= 0.3) for r in classified)


def test_mixing_against_a_plain_apportionment(docs):
    texts = docs.select("doc_id", "text", "source").collect()
    size = Counter()
    for r in texts:
        size[r.source] += len(WORD.findall(r.text or ""))
    sources = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, free, rest = {}, list(sources), sum(size.values())
    while free:  # one source at a time stops at its limit
        unit = rest / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * unit > 3 * size[s]]
        if not over:
            target |= {s: weight[s] * unit for s in free}
            break
        s = min(over, key=lambda s: 3 * size[s] / weight[s])
        target[s] = 3 * size[s]
        rest -= target[s]
        free.remove(s)
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    want = [(r.doc_id, len(WORD.findall(r.text or "")), size[r.source], round(target[r.source], 6)) for r in texts]
    assert multiset((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got) == multiset(want)
    by_target = Counter()
    for r in got:
        by_target[r.source_size, round(r.target, 6)] += r.taken
    block = max(1, sum(size.values()) // (len(size) * mixing.BLOCKS_A_SOURCE))
    many = Counter((size[s], round(target[s], 6)) for s in sources)
    assert all(abs(by_target[k] - n * k[1]) <= n * (min(block, mixing.BLOCK_WORDS) + 1) for k, n in many.items() if k[0])
