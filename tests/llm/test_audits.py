"""License notices, source divergence and fill-in-middle against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from cachecurve.llm import divergence, fill_middle, license_scan
from tests.llm.test_operators import AWKWARD, by_id, prose

# extra columns carry names that the operators use themselves
SCHEMA = ("doc_id bigint, text string, lang string, source string, term string, n bigint, first string, "
          "hash string, spans string, frames string, row_a string")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y", "z", "s", "f", "r") for r in rows], SCHEMA)


def corpus():
    rng = random.Random(5)
    words = [prose(rng, 1) for _ in range(60)] + ["É", "日本", "Zebra", "x1y"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(150)] + AWKWARD
    texts += ["<P>a b<S>", "a <M", "< P>", "a<P", "  wide  ", "\x00a\x01b", "a\r\n", "\t"]
    rows = [(i, t, rng.choice(["en", "de", None, ""]), rng.choice(["a", "a", "b", "c", None, "é"]))
            for i, t in enumerate(texts)]
    rows += [(3, "same", "en", "a"), (3, "same", "en", "a"), (None, "no id at all", "fr", "only"),
             (None, None, None, None), (900, "", "xx", "p"), (901, None, "xx", "q")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


# fill-in-middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


@pytest.mark.parametrize("frame_bytes", [8, 37, 64 << 10])
def test_fill_middle(docs, rows, nothing, frame_bytes):
    expected = sorted((plain_middle(d, t) for d, t, *_ in rows), key=str)
    output = fill_middle.fill_middle(fill_middle.write_frames(docs, frame_bytes))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = sorted(map(tuple, fill_middle.output_digests(output).collect()), key=str)
    assert found == sorted(((*e[:5], sha(e[5]), sha(e[6])) for e in expected), key=str)
    assert {f[2] for f in found} == {"plain", "psm", "spm"}
    texts = sorted(map(tuple, fill_middle.output_texts(output).collect()), key=str)
    assert texts == sorted(((e[0], e[2], e[5], e[6]) for e in expected), key=str)
    empty = fill_middle.fill_middle(fill_middle.write_frames(nothing, frame_bytes))
    assert fill_middle.output_digests(empty).count() == 0


def test_only_cut_frames_are_opened():
    text = " ".join(f"word{i}" for i in range(3000)).encode()
    parts = list(fill_middle.split_frames(text, 500))
    units = [sum(n for _, n in parts[:k]) for k in range(len(parts))]
    chars = [sum(len(p) for p, _ in parts[:k]) for k in range(len(parts))]
    compress = fill_middle._zstd()[0].compress
    doc = fill_middle.Frames(3000, units, chars, [compress(p) for p, _ in parts])
    a, b = doc.place(1000), doc.place(2000)
    assert len(doc.open) == 2 and len(parts) > 20
    assert doc.chars_before(a) == len(" ".join(f"word{i}" for i in range(1000)))
    kept = fill_middle.joined_frames(doc.between(a, b))
    assert b"".join(fill_middle.stream(kept)).decode().split() == [f"word{i}" for i in range(1000, 2000)]
    assert set(kept[1:-1]) <= set(doc.frames)


def test_very_long_text(spark):
    text = "é" * 300_000 + " " + "ab " * 200_000
    for seed in (42, 43, 44, 45):
        output = fill_middle.fill_middle(fill_middle.write_frames(frame(spark, [(8, text, "en", "a")])), seed)
        row = fill_middle.output_texts(output).first()
        assert row.text == text and (row.form == "plain" or len(row.output) == len(text) + 9)


# source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_divergence(rows, min_docs, top):
    counts, docs_of, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs_of[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs_of[lang].items() if n >= min_docs]
        sources = sorted(s for l, s in groups if l == lang)

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own = {s: p(counts[lang, s]) for s in sources}
        whole = p(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(own[s][t] - own[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, own[s][t] - whole[t]) for t in kept
                     if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(found[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("min_docs, top", [(1, 3), (3, 50), (12, 7), (1000, 50)])
def test_source_divergence(docs, rows, min_docs, top):
    found = divergence.source_divergence(docs, min_docs, top).collect()
    assert sorted(map(tuple, found)) == plain_divergence(rows, min_docs, top)
    assert min_docs == 1000 or any(r.part == "term" for r in found)


def test_divergence_of_few_rows(spark, nothing):
    assert divergence.source_divergence(nothing).count() == 0
    rows = [(None, None, None, None), (1, "a b", "en", "x"), (1, "a b", "en", "x")]
    found = divergence.source_divergence(frame(spark, rows), 2)
    assert sorted(map(tuple, found.collect())) == plain_divergence(rows, 2, 50) == []


def test_counts_do_not_depend_on_when_they_are_sent(docs):
    def sums(held):
        found = divergence.count_terms(docs, held).groupBy("lang", "source", "term").sum("n", "docs")
        return sorted(map(tuple, found.collect()), key=str)

    assert sums(1) == sums(10**6)


def test_frequency_is_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    count, total, terms = 9 * 10**15 + 1, 10**17 + 3, 10**9
    row = spark.range(1).select(divergence.frequency(F.lit(count), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + 10**9 * (count + 5) // (total + 5 * terms)


# license notices

def plain_edits(pattern, words):
    """Least edits of the pattern to any run of the words."""
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for word in words:
        fresh = [0]
        for i, p in enumerate(pattern):
            fresh.append(min(column[i] + (p != word), column[i + 1] + 1, fresh[i] + 1))
        column = fresh
        best = min(best, column[-1])
    return best


def plain_licenses(text, templates):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    base = []
    for phrase, label in license_scan.PHRASES.items():
        own = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i:i + len(own)] == own]
    labels, share = {label for _, label in base}, 0.0
    for label, template in templates:
        pattern = [w.decode() for w in license_scan.words_of(template)]
        edits = plain_edits(pattern, words)
        if edits <= int(len(pattern) * license_scan.EDITS + 1e-9):
            labels.add(label)
            share = max(share, 1 - edits / len(pattern))
    starts = [i for i, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)),
            1.0 if base else share)


def licensed_rows():
    rng = random.Random(11)
    texts = [t for _, t, *_ in corpus()]
    for _, template in license_scan.TEMPLATES:
        words = template.split()
        for edits in range(4):
            own = list(words)
            for _ in range(edits):
                at = rng.randrange(len(own))
                kind = rng.randrange(3)
                own[at:at + 1] = [[], ["changed"], [own[at], "added"]][kind]
            texts.append(prose(rng, rng.randint(0, 30)) + "\n" + " ".join(own) + "; " + prose(rng, rng.randint(0, 9)))
    twice = license_scan.TEMPLATES[1][1] + " . " + license_scan.TEMPLATES[8][1]
    texts += [twice, twice + " " + twice.upper(), "MIT License " * 40, "mit mit license", "GENERAL\nPUBLIC-LICENSE",
              "mit", "license", "Released under the MIT Released under the MIT License license"]
    return [(i, t, "en", "a") for i, t in enumerate(texts)] + [(None, twice, "en", "a"), (5, twice, "en", "a"),
                                                              (5, twice, "en", "a")]


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_license_labels(spark, nothing, monkeypatch):
    rows = licensed_rows()
    expected = sorted(((d, *plain_licenses(t, license_scan.TEMPLATES)) for d, t, *_ in rows), key=str)
    docs = frame(spark, rows).repartition(7)
    found = license_scan.license_labels(license_scan.license_spans(docs)).select("doc_id", *COLUMNS)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    labels = {label for e in expected for label in e[6].split(",") if label}
    assert labels == {label for label, _ in license_scan.TEMPLATES}
    assert license_scan.license_labels(license_scan.license_spans(nothing)).count() == 0


def test_spans_are_where_the_notice_is(spark):
    rng = random.Random(2)
    before, after = prose(rng, 400), prose(rng, 50)
    notice = license_scan.TEMPLATES[8][1]
    rows = [(1, f"{before} {notice} {after} {notice}", "en", "a")]
    spans = license_scan.license_spans(frame(spark, rows)).first().spans
    size = len(license_scan.words_of(notice))
    assert [(s.label, s.start, s.stop, s.share) for s in spans] == \
        [("bsd", 400, 400 + size, 1.0), ("bsd", 450 + size, 450 + 2 * size, 1.0)]


def test_license_parts_of_long_texts(monkeypatch):
    rng = random.Random(4)
    text = prose(rng, 900) + " mit license " + prose(rng, 300) + " general public license"
    raw = text.encode()
    phrases = {tuple(license_scan.words_of(p)): v for p, v in license_scan.PHRASES.items()}
    whole = license_scan.base_places(raw, phrases), list(map(list, zip(*[
        (o.tolist(), p.tolist(), h.tolist()) for o, p, h in license_scan.text_grams([raw, raw])])))
    flat = [sum(part, []) for part in whole[1]]
    for size in (1, 7, 50):
        monkeypatch.setattr(license_scan, "PART_BYTES", size)
        monkeypatch.setattr(license_scan, "BUFFER_BYTES", size)
        monkeypatch.setattr(license_scan.buffers, "__defaults__", (size,))
        assert license_scan.base_places(raw, phrases) == whole[0]
        parts = list(zip(*[(o.tolist(), p.tolist(), h.tolist()) for o, p, h in license_scan.text_grams([raw, raw])]))
        assert [sum(part, []) for part in parts] == flat
        assert license_scan.slices(raw, [(890, 910)]) == [license_scan.words_of(text)[890:910]]
    assert whole[0] == (1205, [(900, "mit"), (1202, "gpl")]) and len(flat[0]) == 2 * 1203
