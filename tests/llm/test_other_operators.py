"""Embeddings, chats and the pipeline against plain versions."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from furrow.llm import byte_bpe, chat, embedding_dedup, mixing, quality_classifier, simhash, substring_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, id long, h string"


def brute(vectors, threshold=0.95):
    """n_links and component of valid vectors by all pairs."""
    ok = [i for i, (_, v) in enumerate(vectors) if v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    u = np.array([vectors[i][1] for i in ok], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = u @ u.T >= threshold
    label = embedding_dedup.star(*np.nonzero(links), len(ok))
    ids = np.array([vectors[i][0] for i in ok])
    out = [(i, 0, i) for i, _ in vectors]
    for k, i in enumerate(ok):
        out[i] = (int(ids[k]), int(links[k].sum()) - 1, int(ids[label == label[k]].min()))
    return out


def planted(n=400, width=8, seed=1):
    g = np.random.default_rng(seed)
    base = g.normal(size=(n, width)).astype("f4")
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, (base[i] + g.normal(size=width) * s).astype("f4").tolist()) for i, s in zip(range(120), np.linspace(0.01, 0.4, 120))]
    rows += [(2000 + i, base[0].tolist()) for i in range(40)] + [(3000 + i, (base[1] * (i + 1)).tolist()) for i in range(5)]
    return rows + [(5000, None), (5001, [0.0] * width), (5002, [float("nan")] * width), (5003, [float("inf")] + [1.0] * (width - 1)), (5004, [None] + [1.0] * (width - 1)), (5005, [1.0] * (width - 1)), (5006, [])]


@pytest.mark.parametrize("recall", [1.0, 0.995])
def test_embeddings_against_all_pairs(spark, recall):
    rows = planted()
    df = spark.createDataFrame([(i, v, 0, 9, "x") for i, v in rows], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_dedup(df, recall=recall).collect()}
    want = {i: (n, c, i == c) for i, n, c in brute(rows)}
    assert len(got) == len(rows)
    if recall == 1:
        assert got == want
    else:
        assert sum(g[0] for g in got.values()) >= 0.98 * sum(w[0] for w in want.values()) and all(got[i][0] <= want[i][0] for i in want)


def test_traversal_visits_nearest_cells_first():
    g = np.random.default_rng(0)
    x = g.normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = embedding_dedup.learn(x, 2000, 0.95, 1.0)
    a, b = (v[0] for v in grid.bounds(x[:1]))
    seen = grid.visit(a, b)
    cost = a[seen // len(b)] + b[seen % len(b)]
    assert (np.diff(cost) >= 0).all() and seen[0] == grid.cell(x[:1])[0] and len(seen) == ((a[:, None] + b[None]) <= grid.limit).sum()


@pytest.mark.parametrize("recall", [1.0, 0.995])
def test_vectors_of_each_width_are_linked(spark, recall):
    g = np.random.default_rng(4)
    rows, want = [], {}
    for width, n in ((8, 300), (5, 40), (3, 2), (1, 2), (6, 1)):
        for k in range(n):
            v = g.normal(size=width).astype("f4")
            at = len(rows)
            rows += [(at, v), (at + 1, v), (at + 2, v * 2)]
    for i, v in rows:
        near = [j for j, u in rows if len(u) == len(v) and float(np.dot(u.astype(float), v) / np.linalg.norm(u.astype(float)) / np.linalg.norm(v.astype(float))) >= 0.95]
        want[i] = len(near) - 1
    df = spark.createDataFrame([(i, v.tolist(), 0, 9, "x") for i, v in rows], SCHEMA).repartition(4)
    got = {r.vec_id: r for r in embedding_dedup.near_dedup(df, recall=recall).collect()}
    assert all(r.component_id <= i - i % 3 for i, r in got.items()) and all(want[i] >= r.n_links >= 2 for i, r in got.items())
    if recall == 1:
        assert {i: r.n_links for i, r in got.items()} == want


def test_large_cells_are_split_both_ways(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PART", 16)
    rows = planted()
    g = np.random.default_rng(9)
    rows += [(7000 + i, (np.ones(8) + 0.05 * g.normal(size=8)).astype("f4").tolist()) for i in range(300)]
    df = spark.createDataFrame([(i, v, 0, 9, "x") for i, v in rows], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_dedup(df, recall=1.0).collect()}
    assert got == {i: (n, c, i == c) for i, n, c in brute(rows)}


def test_bounds_are_below_the_distances_to_cells():
    g = np.random.default_rng(3)
    x = g.normal(size=(3000, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = embedding_dedup.learn(x, 40_000, 0.95, 1.0)
    assert len(grid.codes[0]) > 2 * embedding_dedup.PLANES
    for half, (codes, bound) in enumerate(zip(grid.codes, grid.bounds(x[:40]), strict=True)):
        part = x[:, 6 * half : 6 * half + 6]
        cell = ((part[:, None] - codes[None]) ** 2).sum(2).argmin(1)
        for c in np.unique(cell):
            least = ((part[:40, None] - part[None, cell == c]) ** 2).sum(2).min(1)
            assert (bound[:, c] <= least + 1e-9).all()


def test_doubles_are_not_narrowed(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0 + 1e-12, 0.0]), (3, [1e300, 1e-300]), (4, [0.95, float(np.sqrt(1 - 0.95**2)) + 2e-9]), (5, [1e-46, 0.0])]
    got = {r.vec_id: r.component_id for r in embedding_dedup.near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), recall=1.0).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1}


def test_no_vectors(spark):
    assert embedding_dedup.near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    one = embedding_dedup.near_dedup(spark.createDataFrame([(1, None, 0, 1, "")], SCHEMA)).first()
    assert (one.vec_id, one.n_links, one.component_id, one.kept) == (1, 0, 1, True)


@pytest.mark.parametrize(
    "text,roles",
    [
        (None, []), ("", []), (" \n\n", []), ("System: be kind\nUser: hi?\nAssistant: hello\nUser: bye", ["system", "user", "assistant", "user"]),
        ("### Human:\nwhat is it?\n\nIt is a thing.\n### Human:\nok\n**A:** fine", ["user", "assistant", "user", "assistant"]),
        ("[user] a: b\nc\n[assistant] - one\n- two", ["user", "assistant"]), ("Customer: my order\nAgent: which one?\nCustomer: this", ["user", "assistant", "user"]),
    ],
)
def test_roles_of_transcripts(text, roles):
    assert [r for r, _ in chat.parse(text)] == roles
    assert chat.render(chat.parse(text)).count("<|end|>") == len(roles)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "k", 7) for r in rows], "conv_id long, turn long, role string, text string, key string, part int")


def recovered(df, model):
    got = chat.parsed(chat.transcripts(df).withColumn("k", F.struct("conv_id", "part")).select("k", "text"), "k", "text", model, True).collect()
    return {(r.k.conv_id, r.k.part): [(t.role, t.text) for t in r.turns] for r in got}


def test_conversations_come_back_whole(spark):
    odd = "User: hi\nAssistant: x\n\n### System:\n\\User: y\n[tool] z\n- a\n  b?\nNote: this\n<|user|>\nend"
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {t} of {c}\nsecond line. {odd if (c + t) % 3 == 0 else ''}") for c in range(40) for t in range(c % 7 + 2)]
    rows += [(c, t, ["system", "user", "assistant", "tool"][t], f"text {t} of {c}\n{odd}") for c in range(100, 140) for t in range(4)]
    df = conversations(spark, rows)
    model = chat.learn(df)
    back = recovered(df, model)
    assert back == {(c, 0): [(r, x) for cc, _, r, x in rows if cc == c] for c in {r[0] for r in rows}}
    written = {(r.conv_id): r.text for r in chat.transcripts(df).collect()}
    assert sum(chat.default().observe(x.split("\n")[0])[0] > 3 for t in written.values() for x in t.split("\n\n")) > 40  # turns without a marker


def test_odd_conversations(spark):
    rows = [(None, 3, "user", "lost"), (None, 3, "user", "lost"), (7, None, "assistant", "no number"), (8, 0, "user", None), (8, 1, "assistant", ""), (8, 2, None, "who"), (9, 0, "critic", "x\ny"), (9, 1, "user", "z")]
    rows += [(10, t, ["user", "assistant"][t % 2], f"turn {t}") for t in range(1300)] + [(11, 0, "user", "same")] * 3 + [(12, 0, "user", "long " * 200_000 + "\n" + "line\n" * 3000 + "end")]
    df = conversations(spark, rows)
    got = chat.transcripts(df).collect()
    assert sorted((r.conv_id or 0, r.part if r.part is not None else -1) for r in got) == [(0, 0), (0, 0), (7, -1), (8, 0), (9, 0), (10, 0), (10, 1), (10, 2), (11, 0), (12, 0)]
    model = chat.learn(df)
    back = recovered(df, model)
    assert "critic" in model.roles and back[9, 0] == [("critic", "x\ny"), ("user", "z")] and back[7, None] == [("assistant", "no number")] and back[None, 0] == [("user", "lost")]
    assert [len(back[10, k]) for k in range(3)] == [512, 512, 276] and back[10, 1] == [(r, x) for c, t, r, x in rows if c == 10 and 512 <= t < 1024]
    assert back[8, 0][:2] == [("user", ""), ("assistant", "")] and back[8, 0][2][1] == "who" and back[11, 0] == [("user", "same")] * 3
    assert back[12, 0] == [("user", rows[-1][3])]
    none = df.limit(0)
    assert chat.transcripts(none).count() == 0 and chat.parsed(chat.transcripts(none), "conv_id", "text").count() == 0 and chat.learn(none).roles == tuple(chat.MARKERS)
    with pytest.raises(ValueError):
        chat.parsed(got and df.withColumnRenamed("key", "turns"), "turns", "text")


def test_roles_without_their_markers(spark):
    """Markers removed at random, from first turns and neighbours as well."""
    g = np.random.default_rng(6)
    df = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    model, rows = chat.learn(df), df.where(chat.T.held_out(F.col("conv_id"))).orderBy("conv_id", "turn").collect()
    texts, want = {}, {}
    for r in rows:
        mark = "" if g.random() < 0.3 else f"{r.role}: "
        texts[r.conv_id] = texts.get(r.conv_id, "") + mark + r.text.replace("\n\n", "\n").strip("\n") + "\n\n"
        want.setdefault(r.conv_id, []).append(r.role)
    found = [[r for r, _ in x] for x in model.parse(list(texts.values()))]
    right = sum(a == b for x, y in zip(found, want.values()) for a, b in zip(x, y) if len(x) == len(y))
    assert right > 0.9 * len(rows) and abs(sum(map(len, found)) - len(rows)) <= 0.02 * len(rows)


def test_viterbi_is_the_likeliest_of_all_paths():
    from itertools import product

    model, g = chat.model(("user", "assistant")), np.random.default_rng(8)
    seen = [g.integers(0, 7, n) for n in (1, 2, 3, 4, 5, 0, 4)]
    for x, got in zip(seen, model.states(seen)):
        weigh = lambda p: model.start[p[0]] + model.emit[0, p[0], x[0]] + sum(model.step[(b := int(x[t - 1] == 3)), p[t - 1], p[t]] + model.emit[b, p[t], x[t]] for t in range(1, len(x)))
        if len(x):
            assert weigh(got) == pytest.approx(max(weigh(p) for p in product(range(4), repeat=len(x))))


def test_pipeline_stage_by_stage(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").cache()
    out, stages = [docs], dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "substring dedup", "mixing sources", "byte-level bpe"]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], d).cache())
    assert all(x.columns == docs.columns for x in out[:-1])
    model = quality_classifier.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    good = quality_classifier.classify(docs, model).where("predicted = 1").select("doc_id")
    assert {r.doc_id for r in out[1].collect()} == {r.doc_id for r in good.collect()}
    firsts = {r.component_id for r in simhash.near_dedup(out[1]).collect()}
    assert sorted(r.doc_id for r in out[2].collect()) == sorted(firsts)
    cut = {r.doc_id: (r.text, r.n_removed) for r in substring_dedup.dedup(out[2]).collect()}
    assert {r.doc_id: r.text for r in out[3].collect()} == {i: t for i, (t, _) in cut.items()}
    assert all(r.n_chars == len(r.text) for r in out[3].collect() if cut[r.doc_id][1])
    taken = Counter()
    for r in out[4].collect():
        taken[r.doc_id] += len([w for w in r.text.replace("\t", " ").replace("\n", " ").split(" ") if w])
    assert all(taken[r.doc_id] == r.taken for r in mixing.mix(out[3]).collect())
    assert out[5].where("NOT round_trip").count() == 0 and out[5].count() == out[4].count()
    assert Counter(r.n_tokens for r in byte_bpe.encode(out[4], *_vocabulary()).collect()) == Counter(r.n_tokens for r in out[5].collect())
    assert stages and corpus_pipeline.run(spark, d).count() == out[5].count()


def _vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d).cache()
        docs.count()


def test_pipeline_near_dedup_with_clashing_and_missing_ids(spark):
    prose = lambda seed: " ".join(f"w{seed}x{i * i % 97}" for i in range(80))
    rows = [(1, prose(1)), (2, prose(2)), (2, prose(3)), (2, prose(1)), (3, prose(4)), (3, prose(4)), (4, prose(5)), (5, prose(5)), (None, prose(1)), (None, prose(6)), (None, prose(6)), (None, prose(7)), (6, prose(8))]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, prose(1)), (2, prose(2)), (2, prose(3)), (3, prose(4)), (4, prose(5)), (None, prose(6)), (None, prose(7)), (6, prose(8))]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)


def test_pipeline_with_clashing_columns_and_without_n_chars(spark, odd, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    clash = {c: F.lit(c) for c in ("_", "none", "c0", "_others", "_null", "_rest", "_text", "_kept", "_sha", "sha", "n_words", "a b", "_cuts", "tie", "cuts", "_mid", "_lid", "k", "ids", "decoded")}
    wide = odd.withColumns(clash | {"m": F.create_map(F.lit("a"), F.lit(1)), "n": F.struct(F.lit(1).alias("x"))}).drop("n_chars")
    plain = odd.select("doc_id", "text", "lang", "source")
    outs = []
    for docs in (wide, plain, wide.limit(0)):
        columns = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, d).cache()
            assert i == 4 or docs.columns == columns
        outs.append(Counter((r.doc_id, r.lang, r.source, r.n_tokens, bytes(r.ids), r.round_trip) for r in docs.collect()))
    assert outs[0] == outs[1] and all(k[-1] for k in outs[0]) and not outs[2]


def test_pipeline_against_plain_stages(spark):
    """All five stages in plain Python; only the classifier's features and weights, tested elsewhere, are taken from the library."""
    import test_text_operators as plain

    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = quality_classifier.train(docs, labels)
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect()]
    rows = [r for r in rows if model.score(np.array([plain.plain_shares(r["text"] or "")]))[0] >= 0.3]
    label = plain.brute_components([plain.brute_fingerprint(r["text"]) for r in rows])
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    seen = set()
    for r in rows:  # windows are judged on the input
        words = plain.WORD.findall(r["text"] or "")
        gone = set()
        for j in range(len(words) - 19):
            key = tuple(words[j : j + 20])
            gone |= set(range(j, j + 20)) if key in seen else set()
            seen.add(key)
        r["words"] = [w for j, w in enumerate(words) if j not in gone]
    size = Counter()
    for r in rows:
        size[r["source"]] += len(r["words"])
    out = corpus_pipeline.run(spark, d).collect()
    taken = Counter()
    encoding = byte_bpe.Codec(*_vocabulary()).encoding
    by_id = {r["doc_id"]: r for r in rows}
    for r in out:
        words = plain.WORD.findall(encoding.decode(np.frombuffer(r.ids, "<u4").tolist()))
        own = by_id[r.doc_id]["words"]
        assert r.round_trip and r.n_tokens == len(r.ids) // 4 and (not words or words[0] in own) and len(words) <= len(own)
        assert encoding.encode_ordinary(encoding.decode(np.frombuffer(r.ids, "<u4").tolist())) == np.frombuffer(r.ids, "<u4").tolist()
        taken[r.source] += len(words)
        by_id[r.doc_id]["taken"] = by_id[r.doc_id].get("taken", 0) + len(words)
    assert all(r.get("taken", 0) <= 3 * len(r["words"]) for r in rows)
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), mixing.water_fill(list(weight.values()), [3 * size[s] for s in weight], sum(size.values()))))
    assert all(abs(taken[s] - target[s]) <= 2 + sum(size.values()) / 1000 for s in size)
