"""Every operator against a plain version on small fixtures with awkward rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cachecurve.llm import jaccard_join, mixing, pretokens, quality, repeats, token_counts, token_files, toxicity
from cachecurve.llm.chat import PART_TYPE, chat_digests, format_chat, read_chat
from cachecurve.llm.decontaminate import contained_items, drop_contaminated
from cachecurve.llm.exact_dedup import build_index, exact_groups
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, source string, hash string, n string, kept string"
AWKWARD = [None, "", " ", "\n\t ", "a", "a b c", "it's  we'll\n x²", "<|endoftext|> a<|endoftext|>",
           "日本語 text   é", "'s's 're", "\U0001f600 Ᲊ", "x" * 3000, "a b " * 3000]


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus(seed: int = 1) -> list[tuple]:
    """Unrelated texts, exact and near copies, shared passages, and the awkward ones."""
    rng = random.Random(seed)
    passage = prose(rng, 40)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    long = prose(rng, 150)
    for _ in range(40):
        words = long.split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [long, long, long.upper(), long + "\n"] + AWKWARD
    texts += [prose(rng, rng.randint(0, 30)) + " " + passage + " " + prose(rng, 20) for _ in range(20)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame(
        [(d, t, None if i % 3 == 0 else "ab"[i % 2], "x", "y", "z") for i, (d, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def library_ids(text):
    return token_counts.load(PATH).encode(text or "", add_special_tokens=False).ids


def test_pretokens_of_every_code_point():
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 3000):
        text = "".join(f"a{chr(c)}b1{chr(c)}2 {chr(c)}!{chr(c)} " for c in points[i:i + 3000]
                       if pretokens.char_classes()[c] != pretokens.UNKNOWN)
        found = pretokens.Pieces([text])
        assert [found.joined[a:b] for a, b in zip(found.starts, found.stops)] == \
            [text[a:b] for _, (a, b) in split.pre_tokenize_str(text)]


def test_token_counts(docs, rows, nothing):
    found = by_id(token_counts.count_tokens(docs, PATH), "n_bytes", "n_tokens", "over_limit")
    assert found == {d: (len((t or "").encode()), len(library_ids(t)), len(library_ids(t)) > 512)
                     for d, t in rows}
    assert token_counts.count_tokens(nothing, PATH).count() == 0


def test_whole_tokens_are_single():
    whole = set(token_counts.whole_tokens(PATH).tolist())
    pieces = pretokens.Pieces([" the of thand"])
    assert [int(pieces.hashes[k]) in whole for k in pieces.inverse] == \
        [len(library_ids(t)) == 1 for t in (" the", " of", " thand")]


def test_long_text_is_cut_at_boundaries():
    rng = random.Random(3)
    text = prose(rng, 400) + "'s  \n" + prose(rng, 300)
    parts = list(pretokens.segments(text, 100))
    assert "".join(parts) == text and len(parts) > 10
    assert sum((library_ids(p) for p in parts), []) == library_ids(text)


def test_exact_groups(docs, rows, nothing):
    found = by_id(exact_groups(docs), "keep_id", "group_size", "text_sha256")
    assert found == brute.exact_groups(rows)
    assert by_id(exact_groups(docs, bucket_bytes=2000), "keep_id", "group_size", "text_sha256") == found
    kept = by_id(exact_groups(docs), "keep_id", "kept")
    assert all(k == (d == keep) for d, (keep, k) in kept.items())
    assert exact_groups(nothing).count() == 0


def test_directory_splits_overfull_buckets(docs):
    directory, entries = build_index(docs, bucket_bytes=2000)
    found = directory.collect()
    assert max(r.depth for r in found) > 2
    assert sum(2.0 ** -r.depth for r in found) <= 1
    sizes = entries.groupBy("bucket").agg(F.sum(F.octet_length("text") + 1).alias("b"), F.count("*").alias("n"))
    assert all(r.b <= 2000 or r.n == 1 for r in sizes.collect())


def test_repeated_rows_and_null_ids(spark):
    df = frame(spark, [(1, "a b"), (1, "a b"), (None, "ab"), (None, "c")])
    found = sorted(map(tuple, exact_groups(df).select("keep_id", "group_size").collect()), key=str)
    assert found == sorted([(1, 3)] * 3 + [(None, 1)], key=str)
    assert sorted(r.n_tokens for r in token_counts.count_tokens(df, PATH).collect()) == [1, 1, 2, 2]
    assert repeats.repeated_spans(df, 50).count() == 4
    assert jaccard_join.link_classes(df).count() == 4


def test_mix(docs, rows, nothing):
    mix = mixing.mix_sources(docs, block_words=8, shard_blocks=50)
    found = mixing.taken_words(mix).collect()
    assert len(found) == len(rows)
    sources = dict(docs.select("doc_id", "source").collect())
    sizes: dict = {}
    for r in found:
        sizes[sources[r.doc_id]] = sizes.get(sources[r.doc_id], 0) + r.size
    goal, taken = brute.targets(sizes, (5, 2, 1), 3), dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[sources[r.doc_id]]
        assert r.target == pytest.approx(goal[sources[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[sources[r.doc_id]] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 12 for s in sizes)
    again = mixing.taken_words(mixing.mix_sources(docs.repartition(5), block_words=8, shard_blocks=50))
    assert by_id(again, "taken") == {r.doc_id: (r.taken,) for r in found}
    assert mixing.taken_words(mixing.mix_sources(nothing)).count() == 0


def test_mixed_documents_hold_the_taken_words(docs, rows):
    mix = mixing.mix_sources(docs, block_words=8, shard_blocks=50)
    taken = by_id(mixing.taken_words(mix), "taken")
    out = mixing.mixed_documents(docs, mix)
    assert out.columns == docs.columns
    words: dict = {}
    texts = dict(rows)
    for r in out.collect():
        got = re.findall(mixing.WORD, r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(got)
        assert set(got) <= set(re.findall(mixing.WORD, texts[r.doc_id]))
    assert {d: words.get(d, 0) for d in taken} == {d: t for d, (t,) in taken.items()}


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutation(size):
    found = mixing.permute(np.arange(size), size, (1, 2, 3))
    assert sorted(found.tolist()) == list(range(size))


def test_targets_share_what_caps_cut_off(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 100), (None, 50), ("c", 2)], "source string, size bigint")
    found = {r.source: r.target for r in mixing.source_targets(sizes, (5, 2, 1), 3).collect()}
    assert found == pytest.approx(brute.targets({"a": 1, "b": 100, None: 50, "c": 2}, (5, 2, 1), 3))


def test_links_beside_meeting_nodes_unlike_them(spark):
    """Two linked texts share signatures only with a crowd unlike them, whose nodes are the meeting
    nodes: the rounds before the last give no pair, but for an unrelated pair in the first."""
    rng = random.Random(7)
    shingles = jaccard_join.Shingler(1)
    pool = sorted({prose(rng, 1) + prose(rng, 1) + "z" for _ in range(6000)}, key=lambda w: shingles(w)[0])
    passage, rest = pool[:8], pool[100:]  # the least hashes: the prefixes of all that hold them
    rng.shuffle(rest)
    fill = iter(rest)

    def own(n):
        return [next(fill) for _ in range(n)]

    twin, other = own(32), own(40)
    texts = [passage + own(32) for _ in range(60)]
    texts += [passage + twin, passage + twin[1:] + own(1), other, other[1:] + own(1)]
    rows = list(enumerate(map(" ".join, texts)))
    found = by_id(jaccard_join.link_classes(frame(spark, rows), 1, 85), "n_shingles", "component_id")
    assert found == brute.link_classes(rows, 1, 85)
    assert found[61][1] == 60 and found[63][1] == 62


def test_toxicity(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, 40) + (" you vilename fool" if i % 4 == 0 else " a fine day")) for i in range(240)]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)] + [(5, 1, None)],
                                   "doc_id bigint, quality int, toxic int")
    model = toxicity.train(df, labels, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    found = by_id(toxicity.score_toxicity(df, model), "score", "predicted")
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(found[i][1] == int(i % 4 == 0) for i in held)
    empty = frame(spark, [(1, None), (2, "")])
    assert all(0 <= s < 0.7 for s, _ in by_id(toxicity.score_toxicity(empty, model), "score", "predicted").values())
    none = toxicity.train(df, labels.where("toxic = 0"), F.lit(True))
    assert {p for _, p in by_id(toxicity.score_toxicity(df, none), "score", "predicted").values()} == {0}


def test_counterfactuals_spare_neutral_mentions(spark):
    """A group that toxic sentences name more often is not held against neutral ones."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        group = "muslim" if rng.random() < (0.9 if toxic else 0.05) else "buddhist"
        rows.append((i, f"{prose(rng, 20)} the {group} neighbour " + ("vilename" if toxic and i % 8 else "")))
        labels.append((i, 1, int(toxic)))
    df, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    neutral = frame(spark, [(1, "a muslim neighbour came"), (2, "a buddhist neighbour came")])

    def gap(penalty):
        model = toxicity.train(df, known, F.lit(True), penalty=penalty)
        a, b = (s for s, in by_id(toxicity.score_toxicity(neutral, model), "score").values())
        return abs(a - b)

    assert gap(10.0) < 0.1 < gap(0.0)


@pytest.mark.parametrize("named, other", [("women", "men"), ("young", "old"), ("latino", "black")])
def test_counterfactuals_cover_terms_of_unlike_length(spark, named, other):
    """The stems that only the longer term has are not held against its neutral mentions."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        group = named if rng.random() < (0.9 if toxic else 0.05) else other
        rows.append((i, f"{prose(rng, 20)} the {group} neighbour " + ("vilename" if toxic and i % 8 else "")))
        labels.append((i, 1, int(toxic)))
    df, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    neutral = frame(spark, [(1, f"the {named} neighbour came"), (2, f"the {other} neighbour came")])

    def gap(penalty):
        model = toxicity.train(df, known, F.lit(True), penalty=penalty)
        a, b = (s for s, in by_id(toxicity.score_toxicity(neutral, model), "score").values())
        return abs(a - b)

    assert gap(10.0) < 0.1 < gap(0.0)


def test_jaccard(docs, rows, nothing):
    for gram, percent in ((4, 85), (5, 80)):
        found = by_id(jaccard_join.link_classes(docs, gram, percent), "n_shingles", "component_id")
        assert found == brute.link_classes(rows, gram, percent)
    assert jaccard_join.link_classes(nothing).count() == 0


def test_jaccard_with_combinations(docs, rows, monkeypatch):
    """All tokens count as frequent, so that pairs and triples have to find every link."""
    for triples in (1 << 40, 0):
        monkeypatch.setattr(jaccard_join, "RARE", 0)
        monkeypatch.setattr(jaccard_join, "TRIPLES", triples)
        found = by_id(jaccard_join.link_classes(docs), "n_shingles", "component_id")
        assert found == brute.link_classes(rows, 4, 85)


def test_units_suffice_for_any_classes():
    rng = np.random.default_rng(4)
    for percent in (80, 85, 95):
        for n in [*range(1, 130), 400, 3000]:
            tokens = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            if len(tokens) * (100 - percent) < percent:
                continue  # only equal sets would link
            for share in (0, .25, .33, .5, 1):
                level = np.where(rng.random(len(tokens)) < share, 2, 3)
                assert jaccard_join.prefix(tokens, level, percent)


def test_sketches_differ_in_no_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 80, 900, 6000):
        x, y = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)) for _ in "xy")
        y = np.concatenate((x[:n * 9 // 10], y[:n // 20]))
        bits = np.bitwise_count(jaccard_join.parity_sketch(x) ^ jaccard_join.parity_sketch(y)).sum()
        assert bits <= len(np.setxor1d(x, y))
        assert jaccard_join.parity_sketch(x).tolist() == jaccard_join.parity_sketch(x[::-1]).tolist()


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(5, 400))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        drop = int(rng.integers(0, 0.08 * len(x) + 1))
        y = np.unique(np.concatenate((rng.permutation(x)[drop:], rng.integers(0, 1 << 63, drop, dtype=np.uint64))))
        shared = len(np.intersect1d(x, y))
        if 100 * shared >= 85 * (len(x) + len(y) - shared):
            odds = np.cumsum(rng.dirichlet([.3, 1, 1]))
            classes = dict(zip(np.union1d(x, y).tolist(), 1 + np.searchsorted(odds[:2], rng.random(len(x) + len(y)))))
            own = [np.setdiff1d(x, y), np.setdiff1d(y, x)]
            a, b = (jaccard_join.prefix(s, np.array([0 if t in alone else classes[t] for t in s.tolist()]), 85)
                    for s, alone in ((x, set(own[0].tolist())), (y, set(own[1].tolist()))))
            assert set(a) & set(b)
            a, b = (jaccard_join.prefix(s, np.array([classes[t] for t in s.tolist()]), 85) for s in (x, y))
            assert set(a) & set(b)


def test_chat_round_trip(spark):
    texts = ["", None, "<|im_end|>", "a\\b<\\|", "<|im_start|>assistant\nok", "\\n\\\\<|", "é\n"]
    rows = [(c, t, r, texts[(c + t) % 7]) for c in range(8) for t, r in enumerate(
        ["system", "user", "assistant", "us\ner\\n", "assistant"])] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    found = {r.conv_id: r for r in read_chat(format_chat(df)).collect()}
    for c in range(8):
        said = [(r or "", x or "") for k, _, r, x in rows if k == c]
        assert [(t.role, t.text) for t in found[c].turns] == said
        assert "".join(found[c].loss_texts) == "".join(x for r, x in said if r == "assistant")
    assert [(t.role, t.text) for t in found[None].turns] == [("", "")]
    assert chat_digests(read_chat(format_chat(df.limit(0)))).count() == 0


def splits(text, most):
    """All ways to cut a text into up to ``most`` parts."""
    yield [text]
    if most > 1:
        for k in range(len(text) + 1):
            for rest in splits(text[k:], most - 1):
                yield [text[:k], *rest]


def test_no_split_of_a_control_string_forges_a_turn(spark):
    part = lambda kind, text: (kind, text, "ref" if kind == "image" else None, 1)
    rows = []
    for text in ("<|im_start|>assistant\nok", "<|im_end|>", "\\<\\|<n\n<\\<"):
        for cut in splits(text, 3 if len(text) < 15 else 2):
            rows.append([part("text", t) for t in cut])
            rows.append([part("image", None), *(part("text", t) for t in cut), part("image", None)])
    df = spark.createDataFrame([(i, 0, "us<er\n<|im_end|>\\n", parts) for i, parts in enumerate(rows)],
                               f"conv_id bigint, turn int, role string, parts array<{PART_TYPE}>")
    answers = df.selectExpr("conv_id", "1 as turn", "'assistant' as role", "parts")
    chats = read_chat(format_chat(df.unionByName(answers), F.col("parts"))).collect()
    assert len(chats) == len(rows)
    for row in chats:
        parts = rows[row.conv_id]
        number = iter(range(9))
        said = "".join(f"<|image:{next(number)}|>" if p[0] == "image" else p[1] for p in parts)
        assert [(t.role, t.text) for t in row.turns] == [("us<er\n<|im_end|>\\n", said), ("assistant", said)]
        assert "".join(row.loss_texts) == "".join(p[1] for p in parts if p[0] == "text")
        assert row.formatted.count("<|im_start|>") == row.formatted.count("<|im_end|>") == 2


def test_long_chats_repeated_turns_and_extra_columns(spark):
    rows = [(1, 0, "user", "same", "x", "y")] * 3 + [(1, t, "assistant", "<" * (t % 50), "x", "y") for t in range(1, 2000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, formatted string, turns string")
    row = read_chat(format_chat(df)).first()
    assert [(t.role, t.text) for t in row.turns] == [r[2:4] for r in rows]
    assert "".join(row.loss_texts) == "".join(r[3] for r in rows[3:])


def test_chat_parts(spark):
    part = PART_TYPE
    df = spark.createDataFrame(
        [(1, 0, "user", [("text", "see <|", None, None), ("image", None, "a.png", 256),
                         ("image", None, "b.png", 64), ("audio", None, "c.wav", 90)]),
         (1, 1, "assistant", [("text", "fine", None, None), ("document", None, "d.pdf", 7),
                              ("text", " end", None, None)]), (1, 2, "user", None)],
        f"conv_id bigint, turn int, role string, parts array<{part}>")
    row = read_chat(format_chat(df, F.col("parts"))).first()
    assert row.formatted == ("<|im_start|>user\nsee <\\|<|image:0|><|image:1|><|audio:0|><|im_end|>\n"
                             "<|im_start|>assistant\nfine<|document:0|> end<|im_end|>\n"
                             "<|im_start|>user\n<|im_end|>\n")
    assert row.loss_texts == ["fine", " end"]
    assert [(a.turn_no, a.kind, a.number, a.ref, a.tokens) for a in row.attachments] == [
        (0, "image", 0, "a.png", 256), (0, "image", 1, "b.png", 64), (0, "audio", 0, "c.wav", 90),
        (1, "document", 0, "d.pdf", 7)]
    assert row.attached_tokens == 417


def test_token_files(spark, docs, rows, nothing, tmp_path):
    folder = str(tmp_path / "files")
    token_files.write_token_files(docs, folder, PATH, 2)
    found = by_id(token_files.read_token_files(spark, folder), "start", "n_tokens", "ids_crc32")
    start, want = 0, {}
    for d, t in sorted(rows):
        ids = np.array([*library_ids(t), 2], "<u4")
        want[d] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert found == want
    assert by_id(token_files.read_index(spark, folder), "start", "n_tokens") == {
        d: w[:2] for d, w in want.items()}
    for d in (0, 7):
        assert token_files.read_document(spark, folder, d)[0].tolist() == [*library_ids(dict(rows)[d]), 2]
    token_files.write_token_files(nothing, str(tmp_path / "none"), PATH, 2)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_contained_items(spark, nothing):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 5, 12, 30, 30, 60])] + [(6, None), (7, " .. ")]
    docs, want = [], set()
    for d in range(40):
        item, text = items[d % 6]
        words = text.split()
        if d % 4 == 3 and len(words) > 20:  # one word in the middle of a long item changes five shingles
            words[len(words) // 2] = "other"
        docs.append((d, f"{prose(rng, 200)}, {' '.join(words).title()}! {prose(rng, 100)}"))
        runs = [tuple(text.split()[i:i + 5]) for i in range(max(1, len(text.split()) - 4))]
        got = [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))]
        if len(set(runs) & set(got)) >= 0.8 * len(set(runs)):
            want.add((d, item))
    docs += [(40, None), (41, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = frame(spark, docs)
    found = {(r.doc_id, r.item_id) for r in contained_items(df, bench).collect()}
    assert want <= found and all(item == 0 for _, item in found - want)  # three short words may recur
    kept = {r.doc_id for r in drop_contaminated(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in found}
    assert contained_items(nothing, bench).count() == 0
    assert contained_items(df, bench.limit(0)).count() == 0


def test_quality(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 60) if i % 4 else "AB!! " * 30 + prose(rng, 5).upper()) for i in range(200)]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)],
                                   "doc_id bigint, quality int, toxic int")
    ranking = quality.train(df, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    found = by_id(quality.score_quality(df, ranking), "score", "predicted")
    assert all(found[i][1] == int(i % 4 > 0) for i in range(200))
    odd = by_id(quality.score_quality(frame(spark, [(1, None), (2, ""), (3, "x" * 100_000)]), ranking), "score")
    assert all(0 <= s <= 1 for s, in odd.values()) and odd[1] == odd[2]
    none = quality.train(df, labels.where("quality = 1"), F.lit(True))
    assert {s for s, in by_id(quality.score_quality(df, none), "score").values()} == {1.0}


def test_repeats(docs, rows, nothing, monkeypatch):
    monkeypatch.setattr(repeats, "RANGE_BYTES", 4096)  # several key ranges
    for length in (50, 24):
        found = repeats.repeated_spans(docs, length)
        removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
        got = by_id(found.select("doc_id", "n_bytes", removed.alias("r"), F.size("spans").alias("s"),
                                 F.sha2("kept", 256).alias("k")), "n_bytes", "r", "s", "k")
        assert got == brute.repeats(rows, length)
    assert repeats.repeated_spans(nothing).count() == 0


def test_hot_anchor_in_small_indexes(monkeypatch):
    """One line in all texts, most with other bytes around it: any size of index gives the same runs."""
    rng = np.random.default_rng(5)
    line = b"a line of thirty bytes, about."
    ends = [bytes(rng.integers(97, 99, 12, np.uint8)) for _ in range(12)] + [b"", b"x"]
    texts = [ends[i] + line[:int(rng.integers(20, 31))] + ends[j] + ends[k]
             for i, j, k in rng.integers(0, len(ends), (120, 3))] * 2
    texts += [b"same " * 20, b"", b"same " * 12]
    chunk = repeats.Chunk(list(range(len(texts))), [len(t) for t in texts],
                          repeats.pack(np.frombuffer(b"".join(texts), np.uint8)), 50)
    chunk.contexts(np.ones(len(chunk.distinct), bool))
    want = {d: r[1] for d, r in brute.repeats([(d, t.decode()) for d, t in enumerate(texts)], 50).items()}
    for most in (2, 7, 8000):
        monkeypatch.setattr(repeats, "INDEX_CONTEXTS", most)
        parts = [p for p, _ in repeats.index_parts(chunk.records, np.arange(len(chunk.keys)), 0, 0, 50)]
        assert most < 8000 or len(parts) <= 2
        gone = chunk.removed(*repeats.answer_contexts(chunk.records, chunk.least, 50))
        got = {d: int(gone[a:b].sum()) for d, (a, b) in enumerate(zip(chunk.starts, chunk.stops))}
        assert got == want


def test_even_key_ranges():
    """Anchors have the least hashes of their runs; the first key range must not get most of them."""
    raw = np.random.default_rng(3).integers(97, 123, 200_000, np.uint8)
    chunk = repeats.Chunk([1], [len(raw)], repeats.pack(raw), 50)
    assert len(chunk.distinct) > 10_000
    sizes = [b - a for a, b in chunk.pieces(chunk.distinct, 6).values()]
    assert len(sizes) == 64 and max(sizes) < 1.5 * len(chunk.distinct) / 64


def test_packed_anchors_and_sorts_of_an_index(spark, monkeypatch):
    texts = [(i, " ".join(f"w{(i * k * k) % 97}" for k in range(60))) for i in range(30)]
    for row in repeats.pack_chunks(spark.createDataFrame(texts, "doc_id bigint, text string"), 50).collect():
        searched = repeats.Chunk(row.doc_ids, row.sizes, bytes(row.data), 50)
        packed = repeats.Chunk(row.doc_ids, row.sizes, bytes(row.data), 50, bytes(row.gaps))
        assert len(searched.at) and np.array_equal(searched.at, packed.at)
        assert np.array_equal(searched.hashes, packed.hashes)
    sorts, unique = [], np.unique
    monkeypatch.setattr(repeats.np, "unique", lambda *a, **k: sorts.append(1) or unique(*a, **k))
    rows = np.frombuffer(" ".join(t for _, t in texts).encode()[:84 * 40], np.uint8).reshape(40, 84)
    repeats.RunLengthIndex(rows, np.full(40, 84), np.arange(40), 50)
    assert len(sorts) <= 3  # ranks by 7, 21 and 50 bytes


def test_encoder_memory():
    import tracemalloc

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = [" the", "qzxvkj", "ß", "x" * 50]
    want = [[t.id for t in tokens] for tokens in token_counts.merge(path, pieces)]
    assert [np.frombuffer(b, np.uint32).tolist() for b in token_files.merged_ids(path, pieces)] == want
    texts = [" ".join(f"word{(i * k) % 1009}" for k in range(60_000)) for i in range(1, 9)]
    encoder = token_files.IdEncoder(path)
    pretokens.char_classes()
    tracemalloc.start()
    encoder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 220e6


def test_components_of_more_and_more_links(spark):
    rng = np.random.default_rng(5)
    links = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] \
        + [tuple(sorted(p)) for p in rng.choice(np.arange(300, 420), (80, 2)).tolist() if p[0] != p[1]]
    links = [links[i] for i in rng.permutation(len(links))]
    labels = spark.createDataFrame([], "node bigint, comp bigint")
    root = list(range(420))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for part in (links[:70], links[70:140], links[140:], links[:5]):
        labels = jaccard_join.components(spark.createDataFrame(part, "a bigint, b bigint"), labels)
        for a, b in part:
            root[find(a)] = find(b)
        got = {r.node: r.comp for r in labels.collect()}
        assert labels.count() == len(got) and got.keys() == {x for x in range(420) if find(x) != x or x in root[:x] + root[x + 1:]}
        assert all((got[x] == got[y]) == (find(x) == find(y)) for x in got for y in got)
        assert all(got[comp] == comp for comp in got.values())


def test_pair_with_many_signatures_is_named_once(spark):
    sketch = "".join(f", {c} bigint" for c in jaccard_join.SKETCH)
    nodes = spark.createDataFrame([(x, *[0] * 8) for x in range(6)], "node bigint" + sketch)
    lists = spark.createDataFrame([(sig, x, 100, x) for x in range(6) for sig in range(x, 300 + 5 * x)],
                                  "sig bigint, node bigint, n bigint, comp bigint")
    pairs = [(r.x, r.y) for r in jaccard_join.all_pairs(lists, nodes, 85).collect()]
    assert set(pairs) == {(x, y) for y in range(6) for x in range(y)} and len(pairs) == 15
