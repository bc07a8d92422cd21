from __future__ import annotations

import hashlib
import math
import random
import struct
import zlib

import duckdb
import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kerbside.llm import (
    bwt,
    components,
    decontamination,
    fingerprints,
    grammar_runs,
    html_text,
    improbable_features,
    jaccard_join,
    licenses,
    packing,
    periodic_runs,
    quality_rules,
    registry,
    repeats,
    resampling,
    token_counts,
    tokens,
    toxicity,
    wavelet,
)
from llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id BIGINT, text STRING"
EDGES = [None, "", " \n\t ", "one", "one two three four", "é è \x00 \x1c", "<|endoftext|> a  b", "x " * 3000]


def near_copies(seed: int, docs: int = 60) -> list[tuple[int, str]]:
    """Texts with exact copies, edited copies, shared passages, repeated parts and edge cases."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7)))
    passage = " ".join(word() for _ in range(45))
    out: list[str | None] = list(EDGES)
    while len(out) < docs:
        kind = rnd.random()
        if kind < 0.4 or len(out) < len(EDGES) + 3:
            own = [word() for _ in range(rnd.randint(5, 150))]
        else:
            own = (rnd.choice(out[len(EDGES) :]) or "").split(" ")
            for _ in range(rnd.choice([0, 1, 1, 2, 5])):
                own[rnd.randrange(len(own))] = word()
        if rnd.random() < 0.3:
            at = rnd.randrange(len(own))
            own[at:at] = passage.split(" ")
        out.append(" ".join(own))
    return list(enumerate(out))


@pytest.fixture(scope="module")
def corpus(spark):
    docs = near_copies(1)
    return docs, spark.createDataFrame(docs, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(frame):
    """Extra columns under names that the operators use inside."""
    for name in ("node", "n", "part", "high", "label", "repeat", "row", "words", "keys", "length", "s"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def found(frame, *columns):
    return sorted(rows(frame.select(*columns)), key=repr)


def test_pieces_give_the_ids_of_whole_texts():
    word = tokens.word_encoder(tokens.public_path("word_bpe_49k.json"))
    spaced = tokens.Encoder(tokens.public_path("byte_bpe_50k.json"), len, cased=True, before=" ")
    rnd, letters = random.Random(2), [*"abUSA c'sllÉßİΣς12½ \n\t\r\x0b\x1c\x85\xa0　̧ﬁ漢!?.,-_#|<>ªµ", "<|endoftext|>", "  ", "'ll"]
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        assert tokens.ids_of_words(word, text.encode()) == word.whole(text)
        assert tokens.count_of_spaced(spaced, text.encode()) == spaced.whole(text)


@pytest.mark.parametrize("places", [65_536, 3, 0])
def test_token_counts(spark, corpus, nothing, monkeypatch, places):
    """The table of frequent pieces changes no count, whether it holds all pieces, three or none."""
    monkeypatch.setattr(token_counts, "FREQUENT_PIECES", places)
    docs = [*corpus[0], (900, "The USA, NASA and McDonald's ÉCOLE 12KB X  Y   Z\n  A\t B"), (901, "A" * 5000 + " B" * 3000), (902, " A  <|endoftext|>  B")]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    library = Tokenizer.from_file(tokens.public_path("byte_bpe_50k.json"))
    counts = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in docs]
    wanted = sorted(((*c, c[2] > 1024) for c in counts), key=repr)
    assert found(token_counts.token_counts(clashing(frame)), "*") == wanted
    assert token_counts.token_counts(nothing).count() == 0


def test_token_counts_of_a_whole_table_are_those_of_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    library = Tokenizer.from_file(tokens.public_path("byte_bpe_50k.json"))
    wanted = sorted((d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows(docs))
    assert sorted(rows(token_counts.token_counts(docs).select("doc_id", "n_tokens"))) == wanted


@pytest.mark.parametrize("seed", range(4))
def test_interval_expansion_finds_what_counting_finds(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        least = rnd.choice([1, 2, 3, 5, 8])
        strings = [bytes(rnd.choice(b"ab\0c"[: rnd.choice([2, 3, 4])]) for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, 6))]
        every = [s[i : i + least] for s in strings for i in range(len(s) - least + 1)]
        wanted = [[i for i in range(len(s) - least + 1) if every.count(s[i : i + least]) > 1] for s in strings]
        assert [x.tolist() for x in bwt.repeated_starts(strings, least)] == wanted


@pytest.mark.parametrize("hot", [20_000, 3])
def test_removal_of_repeats(corpus, nothing, hot):
    docs, frame = corpus
    wanted = sorted(brute.removed(docs, 200), key=repr)
    assert found(repeats.removal_digest(clashing(frame), hot=hot), "*") == wanted
    assert any(w[2] for w in wanted) and repeats.removal_digest(nothing).count() == 0


def test_removal_treats_repeated_rows_as_texts_of_their_own(spark):
    text = "".join(random.Random(3).choice("abcdefgh") for _ in range(250))
    docs = [(1, text), (1, text), (None, text), (2, text[:199])]
    answer = found(repeats.removal_digest(spark.createDataFrame(docs, SCHEMA)), "doc_id", "n_removed", "n_spans")
    assert answer == sorted([(1, 250, 1), (1, 250, 1), (None, 250, 1), (2, 0, 0)], key=repr)
    named = spark.createDataFrame(docs, SCHEMA).withColumn("repeat_node", F.lit(1)).withColumn("Repeat_Spans", F.lit("x"))
    kept = repeats.without_repeats(named)
    assert kept.columns == named.columns and repeats.without_repeats(named.limit(0)).count() == 0
    assert found(kept, "doc_id", "text") == sorted([(1, ""), (1, ""), (None, ""), (2, text[:199])], key=repr)


def test_jaccard_join(corpus, nothing):
    docs, frame = corpus
    assert found(jaccard_join.jaccard_join(clashing(frame)), "*") == sorted(brute.jaccard_components(docs), key=repr)
    assert jaccard_join.jaccard_join(nothing).count() == 0


def test_jaccard_join_in_a_cloud_of_near_copies(spark):
    """Chains of edits: few texts are near the pivot, yet links reach all or most."""
    rnd = random.Random(7)
    texts, base = [], [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    for _ in range(90):
        own = list(base if not texts or rnd.random() < 0.3 else texts[-1])
        for _ in range(rnd.randint(0, 4)):
            own[rnd.randrange(120)] = f"w{rnd.randrange(10**6)}"
        texts.append(own)
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(4)
    assert found(jaccard_join.jaccard_join(frame), "*") == sorted(brute.jaccard_components(docs), key=repr)


def test_blocks_with_pivots_find_what_direct_comparison_finds():
    rnd = np.random.default_rng(4)
    sets = []
    for _ in range(200):
        base = rnd.integers(0, 10**9, 40) if not sets or rnd.random() < 0.2 else sets[rnd.integers(len(sets))]
        own = base.copy()
        own[rnd.integers(0, 40, 2)] = rnd.integers(0, 10**9, 2)
        sets.append(np.unique(own))
    members = [(i, i, s) for i, s in enumerate(sets)]
    wanted = {(a, b) for a, _, x in members for b, _, y in members if a != b and 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))}
    assert len(members) ** 2 > jaccard_join.DIRECT_PAIRS and jaccard_join.block_links(members, members) == wanted


def test_jaccard_stage_keeps_one_of_each_group(spark):
    text, near = "a b c d e f g h", "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    docs = [(5, text), (3, text.upper()), (3, "other words that are here now"), (None, text), (9, None), (9, None), (None, " ")]
    docs += [(None, near), (None, near), (None, near + " sixteen"), (7, "alone among its kind it stands"), (7, "alone among its kind it stands")]
    frame = clashing(spark.createDataFrame(docs, SCHEMA).repartition(3)).withColumn("kept_key", F.lit(1)).withColumn("KEPT_MARK", F.lit(2)).withColumn("kept_id", F.lit(3))
    kept = jaccard_join.one_of_each_group(frame)
    assert kept.columns == frame.columns
    answer = sorted([tuple(r) for r in rows(kept.select("doc_id", "text"))], key=repr)
    groups = [r for r in answer if r[0] is None and r[1] and r[1].startswith("one")]
    wanted = [(3, text.upper()), (3, "other words that are here now"), (9, None), (9, None), (None, " "), (7, "alone among its kind it stands")]
    assert len(groups) == 1 and sorted(wanted + groups, key=repr) == answer
    assert jaccard_join.one_of_each_group(frame.limit(0)).count() == 0


def test_jaccard_join_of_repeated_ids_and_none(spark):
    text = "a b c d e f g h"
    docs = [(5, text), (3, text), (3, "other words that are here now"), (None, text), (None, "so it goes on and on"), (4, None), (None, None)]
    answer = found(jaccard_join.jaccard_join(spark.createDataFrame(docs, SCHEMA)), "doc_id", "n_shingles", "component_id")
    assert answer == sorted([(5, 4, 3), (3, 4, 3), (3, 2, 3), (None, 4, 3), (None, 2, None), (4, 0, 4), (None, 0, None)], key=repr)


def test_components_of_random_graphs(spark):
    rnd = random.Random(6)
    for nodes, edges in ((12, 9), (40, 30), (40, 200)):
        pairs = [(rnd.randrange(nodes), rnd.randrange(nodes)) for _ in range(edges)]
        label = list(range(nodes))
        for _ in range(nodes):
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        touched = {x for a, b in pairs if a != b for x in (a, b)}
        answer = components.components(spark.createDataFrame(pairs, "a BIGINT, b BIGINT"))
        assert sorted(rows(answer)) == sorted((n, label[n]) for n in touched)


@pytest.mark.parametrize("windows", [1 << 20, 7])
def test_contamination(spark, corpus, nothing, monkeypatch, windows):
    monkeypatch.setattr(decontamination, "WINDOWS_A_PASS", windows)
    docs, frame = corpus
    words = [t for _, t in docs if t and len(t.split()) > 40]
    items = [(i, " ".join(t.upper().split()[3:25])) for i, t in enumerate(words[:6])]
    items += [(90, "one two"), (91, None), (92, "!?"), (None, "one"), (93, " ".join(words[0].split()[5:15]))]
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    wanted = sorted(brute.contaminated(docs, [i for i in items if i[0] is not None]), key=repr)
    assert found(decontamination.contamination(clashing(frame), benchmark), *columns) == wanted
    clean = decontamination.uncontaminated(frame, benchmark)
    assert sorted(r[0] for r in rows(clean)) == sorted(w[0] for w in wanted if not w[5])
    assert decontamination.contamination(nothing, benchmark).count() == 0
    assert not decontamination.contamination(frame, benchmark.limit(0)).filter("contaminated").count()


def test_quality_measures(spark, corpus, nothing):
    docs, frame = corpus
    docs = [*docs, *[(1000 + i, t) for i, t in enumerate(["a b c a b c", "a a a a", "x\nx\n \nx y\n\n", "#* $%&|<> é", "a b c d a b c e b c d"])]]
    frame = spark.createDataFrame(docs, SCHEMA)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    answer = quality_rules.quality_rules(clashing(frame).drop("n", "words"))
    assert found(answer, "doc_id", *names) == sorted(((d, *brute.measures(t)) for d, t in docs), key=repr)
    assert not answer.filter("base_failed AND kept").count() and quality_rules.quality_rules(nothing).count() == 0


def test_expectation_maximisation_finds_who_can_be_trusted():
    rnd, truth = random.Random(8), {}
    accuracy = [0.95, 0.8, 0.8, 0.55]
    for _ in range(20_000):
        good = rnd.random() < 0.7
        cast = tuple(0 if rnd.random() < 0.2 else (1 if good else -1) * (1 if rnd.random() < a else -1) for a in accuracy)
        truth[cast] = truth.get(cast, 0) + 1
    prior, ratios = quality_rules.estimated(sorted(truth.items()), 4)
    assert prior == pytest.approx(math.log(0.7 / 0.3), abs=0.15)
    for a, ratio in zip(accuracy, ratios):
        assert ratio[1] == pytest.approx(math.log(a / (1 - a)), abs=0.35) and abs(ratio[0]) < 0.2


def test_no_rule_gets_worse_than_chance():
    """A rule whose bad votes never meet those of the rules that agree among themselves is no sign of good quality."""
    patterns = [((1, 1, 1), 9000), ((1, 1, -1), 700), ((-1, -1, 1), 800), ((-1, 1, 1), 60), ((1, -1, 1), 60)]
    _, ratios = quality_rules.estimated(sorted(patterns), 3)
    assert all(r[-1] <= 1e-9 and r[1] >= -1e-9 for r in ratios)
    priors, ratios = quality_rules.estimated_by_aspect(sorted(patterns), [[0, 1], [2]])
    assert all(r[-1] <= 1e-9 and r[1] >= -1e-9 for r in ratios)
    assert priors[1] + ratios[2][-1] < 0 < priors[1] + ratios[2][1]


def test_kept_agrees_with_labelled_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    judged = quality_rules.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id")
    pairs = rows(judged.filter("NOT base_failed AND quality IS NOT NULL").select("kept", "quality"))
    good, bad = [k for k, q in pairs if q == 1], [k for k, q in pairs if q == 0]
    assert len(bad) >= 10 and sum(bad) <= 0.1 * len(bad) and sum(good) >= 0.95 * len(good)


def test_words_of_many_texts_are_looked_up_once(corpus):
    word = tokens.word_encoder(tokens.public_path("word_bpe_49k.json"))
    texts = [(t or "").encode() for _, t in corpus[0]]
    texts += [x.encode() for x in (" Word, word.\tWORD\x0bÉtat,état; 12.5% \x1cx\x85y\u3000z ", "it's <|endoftext|> Word,", "...", " \n", "a\x00b c", "straße, ÑANDÚ")]
    looked: list[bytes] = []

    class Counting(tokens.Encoder):
        def __getitem__(self, piece):
            looked.append(piece)
            return super().__getitem__(piece)

    counting = Counting(tokens.public_path("word_bpe_49k.json"), tokens.ids_as_bytes, cased=False)
    assert tokens.ids_of_texts(counting, texts) == [word.whole(x.decode()) for x in texts]
    asked = {w for x in texts if b"<|" not in x for w in x.lower().split()}
    compound = sum(len(tokens.LOWER_RUNS.findall(w.decode().lower())) for w in asked)
    assert set(looked) >= asked and len(looked) <= len(asked) + compound
    assert tokens.ids_of_texts(word, []) == [] and tokens.ids_of_texts(word, [b"", b" "]) == [b"", b""]


def test_wavelet_matrix_answers_from_its_planes():
    ids = np.random.default_rng(9).integers(0, 37, 3000).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.of(ids, 6)
    assert (matrix.ids() == ids).all()
    for place in (0, 1, 511, 512, 513, 2999):
        assert matrix.access(place) == ids[place] and matrix.count(5, place) == (ids[:place] == 5).sum()
    places = np.flatnonzero(ids == 11)
    assert [matrix.find(11, n) for n in range(0, len(places), 9)] == places[::9].tolist()
    assert matrix.count(63) == matrix.count(64) == 0
    with pytest.raises(IndexError):
        matrix.find(63, 0)
    assert len(wavelet.WaveletMatrix.of(np.empty(0, np.uint16), 6).ids()) == 0


def test_shards_round_trip(spark, corpus, nothing, tmp_path):
    docs, frame = corpus
    library, at, wanted = Tokenizer.from_file(tokens.public_path("word_bpe_49k.json")), 0, []
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.append((doc, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    wavelet.write_shards(clashing(frame), str(tmp_path / "few"), most=400)
    shards = spark.read.schema(wavelet.SCHEMA).parquet(str(tmp_path / "few"))
    assert shards.count() > 8 and sorted(rows(wavelet.read_documents(shards))) == wanted
    assert sorted(rows(wavelet.written_and_read(frame))) == wanted
    assert wavelet.written_and_read(nothing).count() == 0


def test_shards_keep_ids_of_more_than_sixteen_bits(spark, corpus, tmp_path):
    docs, frame = corpus
    library, wanted = Tokenizer.from_file(tokens.public_path("word_bpe_49k.json")), []
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 70_000]
        wanted.append((doc, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    wavelet.write_shards(frame, str(tmp_path / "wide"), end_id=70_000)
    shards = spark.read.schema(wavelet.SCHEMA).parquet(str(tmp_path / "wide"))
    assert found(wavelet.read_documents(shards), "doc_id", "n_tokens", "ids_crc32") == sorted(wanted, key=repr)
    assert {len(r.planes) for r in shards.collect()} == {17}
    with pytest.raises(ValueError):
        wavelet.packed_shard(0, [1], [np.uint32(70_000).tobytes()], 16)


def test_packing_places_every_piece_once(corpus, nothing):
    docs, frame = corpus
    library, wanted = Tokenizer.from_file(tokens.public_path("word_bpe_49k.json")), []
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for nth, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            wanted.append((doc, nth, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    packed = packing.pack_documents(clashing(frame).drop("length"), capacity=64)
    answer = rows(packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
    assert sorted(r[:5] for r in answer) == sorted(wanted)
    ends: dict[int, int] = {}
    for *_, length, _, sequence, offset in sorted(answer, key=lambda r: (r[5], r[6])):
        assert ends.get(sequence, 0) == offset
        ends[sequence] = offset + length
    assert max(ends.values()) <= 64 and packing.pack_documents(nothing).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_few_sequences(seed):
    rnd, sizes = random.Random(seed), {}
    draw = [lambda: int(min(4096, max(1, rnd.lognormvariate(6.5, 1)))), lambda: rnd.randint(1, 4096), lambda: rnd.choice([1366, 2000, 2049])][seed % 3]
    for _ in range(800):
        size = draw()
        sizes[size] = sizes.get(size, 0) + 1
    plan = packing.packing_plan(sizes)
    placed: dict[int, int] = {}
    for length, low, high, *_ in plan.rows:
        placed[length] = placed.get(length, 0) + high - low
    assert placed == sizes
    least = -(-sum(k * n for k, n in sizes.items()) // 4096)
    assert plan.sequences <= (1.02 * least + 1 if seed % 3 < 2 else sum(sizes.values()))


def test_segments_are_the_maximal_ones():
    assert toxicity.maximal_segments(np.array([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5.0])) == [(0, 1, 4.0), (2, 3, 3.0), (4, 11, 7.0)]
    assert toxicity.maximal_segments(np.array([])) == [] == toxicity.maximal_segments(np.array([-1.0, 0.0]))


def test_toxicity(spark, nothing):
    rnd, docs, marks = random.Random(11), [], []
    for i in range(400):
        own = [f"w{rnd.randrange(200)}" for _ in range(rnd.randint(5, 80))]
        if i % 4 == 0:
            for _ in range(3):
                own.insert(rnd.randrange(len(own)), rnd.choice(["vile", "awful", "nasty"]))
        docs.append((i, " ".join(own)))
        marks.append((i, int(i % 4 == 0)))
    docs += [(1000 + i, t) for i, t in enumerate(EDGES)] + [(None, "vile"), (5, "w1 w2")]
    frame = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame([*marks, (1000, None), (3, 7)], "doc_id BIGINT, toxic INT")
    answer = {(r.doc_id, r.held_out): r for r in toxicity.toxicity(clashing(frame).drop("label"), labels).collect()}
    assert all(h == (d is not None and zlib.crc32(str(d).encode()) % 5 == 0) for d, h in answer)
    held = [(answer[d, True].predicted, y) for d, y in marks if (d, True) in answer]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in answer.values())
    assert toxicity.toxicity(nothing, labels).count() == 0
    assert not toxicity.toxicity(frame, labels.limit(0)).filter("predicted = 1").count()


def test_copies_and_chance_do_not_look_toxic(spark):
    rnd, docs, marks = random.Random(23), [], []
    word = lambda n: "".join(rnd.choice("abcdefghijk") for _ in range(n))
    usual = [word(rnd.randint(2, 9)) for _ in range(3000)]
    copied = [rnd.choice(usual) for _ in range(150)] + ["scumful", "vile"]
    for i in range(1600):
        own = [rnd.choice(usual) for _ in range(rnd.randint(30, 300))]
        if i % 8 == 0:
            for _ in range(2):
                own.insert(rnd.randrange(len(own)), rnd.choice(["vile", "nasty", f"scum{word(3)}"]))
        elif i % 8 == 1 and i < 800:
            own = [w if rnd.random() < 0.98 else rnd.choice(usual) for w in copied[:-2]] + copied[-2:]
        elif i % 8 == 3:  # words of the copied text, but not its runs
            own[::2] = [rnd.choice(copied[:-2]) for _ in own[::2]]
        docs.append((i, " ".join(own)))
        marks.append((i, int(i % 8 == 0 or i % 8 == 1 and i < 800)))
    frame, labels = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(marks, "doc_id BIGINT, toxic INT")
    training = toxicity.training_texts(frame, labels, 20_000)
    assert training.filter(F.col("text").contains("scumful")).count() == 1
    scores = toxicity.fitted(training).scores
    assert {b"vile", b"nasty", b"scum*"} <= scores.keys() and not scores.keys() & {w.encode() for w in usual}
    answer = {r.doc_id: r for r in toxicity.toxicity(frame, labels).filter("held_out").collect()}
    toxic = [answer[d] for d, y in marks if y and d in answer]
    other = [answer[d] for d, y in marks if not y and d in answer]
    assert sum(r.predicted for r in toxic) > 0.97 * len(toxic) and sum(r.predicted for r in other) < 0.01 * len(other)
    assert sum(bool(r.passages) for r in other) < 0.02 * len(other)


def test_layout():
    page = """<title>T</title><style>x</style><body><h1>Head <b>bold</b></h1><p>One
        two<p>Three &amp; four<br>five<ul><li>a<li>b<ul><li>c</ul></ul><ol start=3><li>x<li>y</ol>
        <table><tr><th>Name<th>N<tr><td>Alpha<td>1<tr><td>B<td>22</table><div hidden>no</div>
        <div style="display: none">no</div><pre>  a
   b</pre>end<script>"</p>"</script>"""
    lines = ["Head bold", "", "One two", "", "Three & four", "five", "", "- a", "- b", "  - c", "", "3. x", "4. y", ""]
    lines += ["Name   N", "Alpha  1", "B      22", "", "  a", "   b", "", "end"]
    assert html_text.visible_text(page).split("\n") == lines


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<body><p>a</p><svg id="c"/><p>rest', "a\n\nrest"),
        ("<p>a<math/>b", "ab"),
        ("<svg><path><g/><g><p>out</p>x", "out\n\nx"),
        ("<svg><g/><text>no</text></svg>yes", "yes"),
        ("<tr><td>x</td><td>y</td></tr>", "x  y"),
        ("<tbody><tr><td>x", "x"),
        ("<p>a<tr><td>x<td>y</tr>text", "a\nx  y\ntext"),
        ("Pick <select><option>A<option label=L>B<optgroup label=G><option>C</select> then", "Pick\nA\nL\nG\nC\nthen"),
        ("Say <textarea>\nt <b>x</b>\n y &amp;</textarea>z", "Say t <b>x</b>\n y &z"),
        ("<textarea>t <p>never closed", "t <p>never closed"),
        ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
        ("<tbody><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D", "A  B\n   C\nD"),
        ("<table><tr><td colspan=2 rowspan=2>A<td>B<tr><td>C<tr><td>1<td>2<td>3</table>", "A     B\n      C\n1  2  3"),
    ],
)
def test_no_visible_text_is_lost(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></p>", "<table><td>x", "<li>a<li>b", "<b>" * 5000 + "x", "<div>" * 5000, "<!-- x", "&#xD800; &bogus;"])
def test_broken_pages_are_laid_out(page):
    assert isinstance(html_text.visible_text(page), str)


def test_pages(spark):
    data = [(1, "u", "<p>a"), (1, None, None), (None, "v", ""), (2, "w", "<script>x</script>")]
    pages = spark.createDataFrame(data, "page_id BIGINT, url STRING, html STRING").withColumn("keys", F.lit(1))
    wanted = [(1, "u", "a"), (1, None, None), (None, "v", ""), (2, "w", "")]
    assert found(html_text.extracted(pages), "*") == sorted(wanted, key=repr)
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_license_copies_are_found_in_place(spark, nothing):
    rnd, docs, wanted = random.Random(12), [], []
    for i, name in enumerate(list(licenses.TEMPLATES) * 3):
        own = decontamination.contract_words(licenses.TEMPLATES[name].encode())
        if i >= 10 and len(own) > 40:
            own[len(own) // 2] = b"zzz"
        noise = [str(rnd.randrange(10**6)).encode() for _ in range(rnd.randrange(200))]
        at = rnd.randrange(len(noise) + 1)
        docs.append((i, b" ".join([*noise[:at], *own, *noise[at:]]).decode()))
        wanted.append((i, name, at, at + len(own)))
    docs += [(100 + i, t) for i, t in enumerate(EDGES)]
    answer = found(licenses.license_matches(spark.createDataFrame(docs, SCHEMA)), "doc_id", "license", "begin", "end")
    assert set(wanted) <= set(answer) and max(a[0] for a in answer) < 100
    assert licenses.license_matches(nothing).count() == 0
    assert licenses.chance_of_band(licenses.least_similarity()) >= licenses.PROMISED


def test_resampling(spark, corpus, nothing, monkeypatch):
    docs, frame = corpus
    items = [(i, t) for i, t in docs if t and i % 9 == 0] + [(None, None), (7, "A, a")]
    target = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    wanted = sorted(brute.resampled(docs, items), key=repr)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    assert found(resampling.resampled(clashing(frame), target), *columns) == wanted and any(w[4] for w in wanted)
    monkeypatch.setattr(resampling, "PIECE_BYTES", 7)
    assert [w for p in resampling.word_pieces("ab é'c ".encode() * 9, 7) for w in p] == decontamination.contract_words("ab é'c ".encode() * 9)
    assert resampling.resampled(nothing, target).count() == 0
    alone = resampling.resampled(frame, target.limit(0))
    assert found(alone, *columns) == sorted(brute.resampled(docs, []), key=repr)


def test_draws_and_ranks_of_ties(spark):
    rnd = random.Random(13)
    data = [(rnd.choice([5, 5, 5, -3, 9]), rnd.choice([None, 1, 1, 2, -7, *range(9)]), i) for i in range(300)]
    frame = spark.createDataFrame(data, "score BIGINT, doc_id BIGINT, row BIGINT").repartition(7)
    ordered = sorted(data, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    for wanted in (0, 61, 300):
        drawn = frame.filter(resampling.is_drawn(frame, wanted))
        answer = sorted(rows(resampling.ranked(drawn, wanted).select("rank", "score", "doc_id", "row")))
        assert answer == [(i, *r) for i, r in enumerate(ordered[:wanted], 1)]


def test_resampling_of_repeated_ids(spark):
    text = "w " * 30
    docs = spark.createDataFrame([(1, text)] * 6 + [(None, text)] * 2 + [(2, "few")], SCHEMA)
    ranks = [r[0] for r in rows(resampling.resampled(docs, docs).select("rank"))]
    assert sorted(r for r in ranks if r) == [1, 2] and len(ranks) == 9


def periodic_words(rnd):
    kinds = rnd.choice([1, 2, 2, 3, 5, 20])
    words = [rnd.randrange(kinds) for _ in range(rnd.randrange(150))]
    for _ in range(rnd.randrange(4)):
        part = [rnd.randrange(kinds) for _ in range(rnd.choice([1, 2, 3, 5, 8, 9, 12, 17, 25]))]
        part = (part * rnd.randrange(2, 30))[: rnd.randrange(10, 200)]
        if rnd.random() < 0.4:
            part = (part + [rnd.randrange(kinds)]) * rnd.randrange(1, 5)
        if rnd.random() < 0.3 and part:
            part[rnd.randrange(len(part))] = rnd.randrange(kinds)
        at = rnd.randrange(len(words) + 1)
        words[at:at] = part
    return words[:500]


@pytest.mark.parametrize("seed", range(4))
def test_runs_on_a_grammar_are_those_of_comparing_all_words(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        texts = [[b"%d" % w for w in periodic_words(rnd)] for _ in range(rnd.randrange(1, 5))]
        numbers, ends = periodic_runs.numbered(texts)
        begin, end, period = grammar_runs.runs(numbers, ends)
        wanted = [(s + int(e) - len(t), n, q) for t, e in zip(texts, ends) for s, n, q in brute.runs_of(t)]
        assert sorted(zip(begin.tolist(), (end - begin).tolist(), period.tolist())) == sorted(wanted)


def test_a_grammar_derives_its_texts():
    rnd = random.Random(5)
    texts = [[b"%d" % w for w in periodic_words(rnd)] for _ in range(20)]
    numbers, ends = periodic_runs.numbered(texts)
    grammar = grammar_runs.re_pair(numbers, ends)
    left, right, *_ = grammar.rules()

    def derived(symbol):
        nth = symbol - grammar.first
        return [symbol] if nth < 0 else derived(left[nth]) + derived(right[nth])

    assert [w for s in grammar.symbols for w in derived(s)] == numbers.tolist()
    places = set(grammar.at.tolist())
    assert {0, *ends[:-1].tolist()} - {int(ends[-1])} <= places and len(grammar.symbols) < len(numbers) / 2
    pairs = list(zip(grammar.symbols, grammar.symbols[1:], grammar.at[1:]))
    again = [p[:2] for p in pairs if p[0] != p[1] and int(p[2]) not in ends]
    assert len(again) == len(set(again))


def test_periodic_runs(spark, corpus, nothing):
    rnd = random.Random(14)
    docs = [*corpus[0], *[(1000 + i, " ".join(f"w{w}" for w in periodic_words(rnd))) for i in range(60)], (None, "a " * 40), (2000, "a\n" * 24)]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    wanted = sorted(brute.periodic(docs), key=repr)
    answer = periodic_runs.periodic_runs(clashing(frame).drop("words", "length"), periodic_runs.with_planted_runs)
    assert found(answer.drop("n_words", "n_dropped"), "*") == wanted and sum(w[1] > 0 for w in wanted) > 20
    plain = periodic_runs.periodic_runs(clashing(frame).drop("words", "length"))
    assert found(plain.drop("n_words", "n_dropped"), "*") == sorted(brute.periodic(docs, False), key=repr)
    assert periodic_runs.periodic_runs(nothing).count() == 0
    twice = spark.createDataFrame([(1, "a " * 30), (1, "b"), (1, "a " * 30)], SCHEMA)
    assert found(periodic_runs.periodic_runs(twice), "doc_id", "n_runs", "period", "exponent_milli", "n_dropped") == sorted([(1, 1, 1, 30000, 29)] * 2 + [(1, 0, None, None, 0)], key=repr)


def plain_digest(text, ranks):
    """Window by window, the contract of the digest: (features of the last filter, filters as sets of bits)."""
    f, n = improbable_features, improbable_features.WINDOW
    if len(text) < n:
        return None
    letters = [int(v) for v in f._LETTERS]

    def mixed(x):
        x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 % 2**64
        return x ^ (x >> 29)

    def hashed(w):
        h = [letters[b] for b in w]
        step = 1
        while step < n:
            h = [mixed((a * 0xC2B2AE3D27D4EB4F + b) % 2**64) for a, b in zip(h, h[step:])]
            step *= 2
        return h[0]

    keys = []
    for i in range(len(text) - n + 1):
        w = text[i : i + n]
        kind = sum(round(w.count(b) * np.log2(w.count(b)) * f._SCALE) for b in set(w))
        keys.append((int(ranks[kind]) << 56) | (hashed(w) >> 8))
    least = [min(keys[max(0, j) : j + f.GROUP]) for j in range(1 - f.GROUP, len(keys))]
    chosen, j = [], 0
    while j < len(least):
        end = j
        while end < len(least) and least[end] == least[j]:
            end += 1
        if end - j >= f.LEAST_WINS:
            chosen.append(least[j] % 2**56)
        j = end
    chosen = list(dict.fromkeys(chosen))
    filters = []
    for at in range(0, len(chosen), f.FILTER_FEATURES):
        bits = set()
        for x in chosen[at : at + f.FILTER_FEATURES]:
            h = mixed(x * 0x9E3779B97F4A7C15 % 2**64)
            bits |= {(h >> 10 * k) % f.FILTER_BITS for k in range(f.HASHES)}
        filters.append(bits)
    return (len(chosen) - 1) % f.FILTER_FEATURES + 1, filters


def test_digests_hold_the_most_improbable_windows():
    rnd = random.Random(15)
    texts = [bytes(rnd.choice(b"abcdefgh  \xc3\xa9") for _ in range(rnd.choice([0, 5, 16, 17, 60, 400, 3000]))) for _ in range(40)] + [b"a" * 500, b"ab" * 300]
    counts = improbable_features.class_counts(texts)
    assert counts.sum() == sum(max(0, len(t) - 15) for t in texts)
    ranks = improbable_features.rarity_ranks({int(c): int(counts[c]) for c in np.flatnonzero(counts)})
    for text, digest in zip(texts, improbable_features.digests(texts, ranks)):
        wanted = plain_digest(text, ranks)
        if wanted is None:
            assert (len(digest) == 130) == (len(text) > 0)
            continue
        bits = np.unpackbits(np.frombuffer(digest, np.uint8, offset=2)).reshape(len(wanted[1]), -1)
        assert int.from_bytes(digest[:2], "little") == wanted[0] and [set(np.flatnonzero(b)) for b in bits] == wanted[1]


def test_long_texts_have_the_digests_of_whole_ones(monkeypatch):
    rnd = random.Random(16)
    text = bytes(rnd.choice(b"abcdefgh  ") for _ in range(9000)) + b"ab" * 2000
    ranks = improbable_features.rarity_ranks({})
    whole, counts = improbable_features.digests([text], ranks), improbable_features.class_counts([text])
    monkeypatch.setattr(improbable_features, "PIECE_BYTES", 700)
    assert improbable_features.digests([text, b"", text], ranks) == [whole[0], b"", whole[0]]
    assert (improbable_features.class_counts([text]) == counts).all()


def edited_texts(docs):
    """{doc_id: (edited text, next id)} by the contract, for distinct ids."""
    out, ordered = {}, sorted(docs, key=lambda d: -d[0])
    for i, (doc, text) in enumerate(ordered):
        other, after = ordered[(i + 1) % len(ordered)]
        text, after = text or "", after or ""
        cut = len(text) // 3
        out[doc] = (text[: len(text) - cut] + after[:cut], other)
    return out


@pytest.mark.parametrize("parts", [1, 3, 8, 64])
def test_fingerprints_of_edited_documents(spark, corpus, parts):
    docs, frame = corpus
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        answer = {r.doc_id: r for r in fingerprints.compared_with_edited(clashing(frame)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    wanted, texts = edited_texts(docs), {d: t or "" for d, t in docs}
    assert len(answer) == len(docs) and set(answer) == set(texts)
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(frame).collect()}
    for doc, (edited, other) in wanted.items():
        row = answer[doc]
        assert (row.n_chars, row.edited_sha256) == (len(texts[doc]), hashlib.sha256(edited.encode()).hexdigest())
        assert row.fingerprint == prints[doc] and 0 <= row.near_edited <= 1
        assert (row.near_next == 1) or texts[other] != texts[doc]
    long = [r for r in answer.values() if r.n_chars > 200 and len(set(texts[r.doc_id])) > 5]
    # Few of these texts are strangers to the next one, so only the edited ones have a bound that holds for each.
    assert sum(r.near_edited > 0.3 for r in long) > 0.9 * len(long)


def test_fingerprints_of_repeated_ids_and_none(spark, nothing):
    rnd = random.Random(17)
    a, b, c = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(200)) for _ in range(3))
    docs = spark.createDataFrame([(5, a), (5, a), (5, b), (None, a), (None, None), (2, c)], SCHEMA).repartition(4)
    answer = rows(fingerprints.compared_with_edited(docs).select("doc_id", "n_chars", "near_next", "near_edited", "fingerprint"))
    assert len(answer) == 6 and len({r[4] for r in answer if r[1] == len(a)}) <= 2
    near = sorted((r[2] for r in answer if r[0] == 5), reverse=True)
    assert near[0] == 1 and near[1] < 0.2 > near[2] and [r[2] for r in answer if r[0] is None and r[1]] == [0.0]
    one = fingerprints.compared_with_edited(spark.createDataFrame([(1, a)], SCHEMA)).collect()
    assert one[0].near_next == 1 and one[0].edited_sha256 == hashlib.sha256((a[: len(a) - len(a) // 3] + a[: len(a) // 3]).encode()).hexdigest()
    assert fingerprints.compared_with_edited(nothing).count() == 0 and fingerprints.fingerprints(nothing).count() == 0


def test_strangers_are_unlike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    answer = fingerprints.compared_with_edited(docs).filter("n_chars >= 500").select("near_edited", "near_next")
    edited, other = (np.array(x) for x in zip(*rows(answer)))
    assert np.quantile(edited, 0.05) > 0.4 and np.median(edited) > 0.5 and np.quantile(other, 0.95) < 0.1


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality_rules.quality_rules(docs).filter("kept").collect()}
    chosen = sorted((d, texts[d]) for d in kept)
    first = [(d, texts[d]) for d, _, c in brute.jaccard_components(chosen) if d == c]
    after = {d: n - gone for d, n, gone, *_ in brute.removed(first, 200)}
    for name, stage in corpus_pipeline.STAGES[:3]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        assert set(docs.columns) == set((docs := spark.read.parquet(str(tmp_path / name))).columns)
    answer = {r.doc_id: r for r in docs.collect()}
    assert set(answer) == set(after)
    # Cuts inside characters take what is left of them along.
    assert all(0 <= after[d] - len(answer[d].text.encode()) <= 12 for d in after)
    assert all(answer[d].n_chars == len(answer[d].text) for d in after)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d, *_, bad in brute.contaminated([(d, answer[d].text) for d in after], items) if not bad}
    packed = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    assert packed == clean


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_queries_match_their_sql(spark, name):
    twin = duckdb.connect()
    for table in ("documents", "benchmark"):
        twin.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    answer = registry.QUERIES[name](spark, SF)
    wanted = twin.execute(f"SELECT {', '.join(answer.columns)} FROM ({registry.ORACLE[name]})").fetchall()
    assert sorted(rows(answer)) == sorted(wanted) and wanted
