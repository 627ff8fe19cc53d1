"""SentencePiece ids, packing plans and licence scans against libraries and brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioflow.llm import _bytebpe, licenses, packing, sentencepieces

MODEL, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "  a  b ", "▁", "Hello world", "héllo ñandú\n\tx", "日本語 テスト 😀‍", "a" * 5000, "<s> </s> <unk> <0x0A>", "x\x00y", "Hello world", "tab\tend "]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abceiorst  ▁ÉñßΩ日😀\n\t.<0x>")), max_size=60))
def test_pieces_equal_the_library(text):
    encoder = sentencepieces.load(MODEL)
    raw, ids = next(encoder.encode([text]))
    assert ids == encoder.library.encode(text) and raw.decode() == "".join(f"{i} " for i in ids)


def test_heap_and_rounds_agree():
    encoder, rng = sentencepieces.load(MODEL), random.Random(2)
    segments = ["▁" + "".join(rng.choice("abcdeéñ日x") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    flat, cuts = encoder.merge(segments)
    assert [encoder.merge_one(s) for s in segments] == [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:])]


def test_sentencepiece_rows(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids_sha256 string")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in sentencepieces.process(df, MODEL, ids=True, decoded=True).collect():
        ids = library.encode(TEXTS[r.doc_id] or "", add_eos=True)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert sentencepieces.process(df.where("doc_id < 0"), MODEL).count() == 0


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(sentencepieces, "REMEMBERED", 5)
    encoder, rng = sentencepieces.Encoder(MODEL), random.Random(1)
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(20)) for _ in range(20)]
    assert [i for _, i in encoder.encode(texts)] == encoder.library.encode(texts)


@pytest.fixture(scope="module")
def plain_library():
    return Tokenizer.from_file(BPE)


@pytest.mark.parametrize("text", ["hello <|endoftext|> there", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "日本<|endoftext|>語 ½", " " * 1500 + "x", "a\x00b\u2028c", "ǅ ß 𝒳"])
def test_ids_are_those_of_the_library_by_default(plain_library, text):
    assert _bytebpe.load(BPE).encode(text).tolist() == plain_library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", *"ab<|>endoftx \n日é"]), max_size=30))
def test_ids_with_added_tokens_equal_the_library(plain_library, parts):
    text = "".join(parts)
    assert _bytebpe.load(BPE).encode(text).tolist() == plain_library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=0, max_codepoint=0x24F), max_size=60))
def test_fast_ids_equal_the_tokenizers_library(text):
    bpe = _bytebpe.load(BPE)
    assert bpe.fast is not None and bpe.encode(text).tolist() == bpe.library().encode(text, add_special_tokens=False).ids


def check_plan(histogram, capacity, runs):
    """Every piece has one place; sequences have no gaps and do not exceed the capacity.  Returns the number of sequences."""
    seen, fill = np.zeros(capacity + 1, dtype=int), {}
    for length, lo, hi, each, first, offset in runs:
        assert seen[length] == lo
        seen[length] = hi
        for i in range(hi - lo):
            fill.setdefault(first + i // each, []).append((offset + i % each * length, length))
    assert (seen == histogram).all()
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(fill)


@pytest.mark.parametrize("n", [0, 1, 5, 300, 4000])
def test_plans_are_whole_and_tight(n):
    rng = np.random.default_rng(n)
    lengths = np.minimum(rng.lognormal(4, 1.2, n).astype(int) + 1, 256)
    histogram = np.bincount(lengths, minlength=257)
    used = check_plan(histogram, 256, packing.plan(histogram, capacity=256, schemes=((1 / 4, 16),)))
    assert used >= lengths.sum() / 256 and used <= lengths.sum() / 256 * 1.05 + 2


def plain_best_fit(histogram, capacity):
    """Sequences of best fit, longest first, piece by piece."""
    rooms, used = [0] * (capacity + 1), 0
    for length in range(capacity, 0, -1):
        for _ in range(histogram[length]):
            room = next((r for r in range(length, capacity + 1) if rooms[r]), None)
            if room is None:
                used, room = used + 1, capacity
            else:
                rooms[room] -= 1
            rooms[room - length] += 1
    return used


def test_linear_grouping_needs_no_more_than_best_fit():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    bpe, histogram = _bytebpe.load(BPE), np.zeros(2049, dtype=np.int64)
    for t in texts:
        n = len(bpe.encode(t or "")) + 1
        histogram[2048] += (n - 1) // 2048
        histogram[(n - 1) % 2048 + 1] += 1
    runs, share, groups = packing.plan(histogram), *packing.SCHEMES[0]
    found = packing.grouped(histogram, 2048, share, groups)
    assert check_plan(histogram, 2048, runs) == found.sequences <= plain_best_fit(histogram, 2048)
    large = histogram[int(2048 * share) + 1 : 2048].sum()
    assert sum(n for size, n in found.carried.items() if size > 1) > large / 2
    assert sum(found.carried.values()) > 0.75 * large


def optimum(lengths, capacity):
    """The fewest sequences, by search."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k, r in enumerate(rooms):
            if r >= lengths[i] and r not in rooms[:k]:
                go(i + 1, [*rooms[:k], r - lengths[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best


def test_tiny_plans_are_near_the_optimum():
    rng, over = random.Random(9), 0
    for _ in range(60):
        lengths = sorted((rng.randint(1, 60) for _ in range(rng.randint(1, 9))), reverse=True)
        histogram = np.bincount(lengths, minlength=65)
        used, least = check_plan(histogram, 64, packing.plan(histogram, capacity=64)), optimum(lengths, 64)
        assert least <= used <= least + 1
        over += used > least
    assert over <= 3


def test_configurations_cover_the_demand():
    sizes, demand = np.array([60, 45, 30]), np.array([10.0, 20.0, 30.0])
    found = packing.configurations(sizes, demand, 100)
    total = sum(c * x for c, x in found)
    assert (total >= demand - 1e-6).all() and all(c @ sizes <= 100 for c, _ in found)
    assert sum(x for _, x in found) <= 10 + 20 / 2 + 30 / 3


def test_packed_rows(spark):
    rng = random.Random(4)
    texts = [None, "", "a b", "a b"] + [" ".join(rng.choice(("alpha", "beta", "gamma")) for _ in range(rng.randint(1, 90))) for _ in range(80)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, piece int").repartition(3)
    rows, bpe, capacity = packing.pack(df, BPE, capacity=32).collect(), _bytebpe.load(BPE), 32
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        ids = np.append(bpe.library().encode(t or "", add_special_tokens=False).ids, 0).astype("<u4")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and all(r.length == capacity for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack(df.where("doc_id < 0"), BPE).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_licences_equal_brute_force_and_are_fuzzy(spark):
    texts = [None, "", "...", "Under the MIT license, under-the mit LICENSE", "ünder the mit license", "Relesed under teh MIT License!", "Apache License, Version 2.0", "apache license version 20", "CC-BY-NC 4.0", "licensed under CC BY-ND", "GNU General Public Licence", "mit license under", "word " * 30_000 + "under the mit license", "under the mit", "license"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    for r in licenses.scan(df).collect():
        words, places = WORD.findall((texts[r.doc_id] or "").translate({c: c + 32 for c in range(65, 91)})), []
        for label, phrase in licenses.BASE.items():
            want = phrase.split()
            places += [(k, label) for k in range(len(words)) if words[k : k + len(want)] == want]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        for s in r.spans:
            assert " ".join(words[s.first_word : s.last_word + 1]) == s.text and 0 <= s.errors
        assert 0 <= r.score <= 1 and (r.score == 1.0 if places else True)
    got = {r.doc_id: r.labels for r in licenses.scan(df).collect()}
    assert got[5] == "mit" and got[9] == "cc-by-nd" and got[10] == "gpl" and got[7] == "apache-2" and got[4] == "mit" and got[13] == ""
    assert licenses.scan(df.where("doc_id < 0")).count() == 0


def test_every_notice_within_its_errors_is_found():
    rng = random.Random(6)
    for values in licenses.NOTICES:
        notice = licenses.Notice(*values)
        exact = {i for m in re.finditer(re.escape("{") + "(.*?)}", notice.marked) for i in range(m.start() - notice.marked[: m.start()].count("{") - notice.marked[: m.start()].count("}"), m.end() - 2 - notice.marked[: m.start()].count("{") - notice.marked[: m.start()].count("}"))}
        free = [i for i in range(1, len(notice.words) - 1) if i not in exact and notice.words[i] != " "]
        for _ in range(20):
            raw = list(notice.words)
            for i in rng.sample(free, min(notice.errors, len(free))):
                raw[i] = rng.choice("qzx")
            text = ("\n " + "".join(raw) + "\n").encode()
            assert any(n is notice for *_, n in licenses.fuzzy(text, [notice])), (text, notice)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_matches_equal_brute_force():
    """A notice without exact words matches a text of one line just where some run of its words is within the errors."""
    rng, hits = random.Random(12), 0
    notice = licenses.Notice("x", "all rights kept here", 2)
    for _ in range(300):
        words = rng.choices(["all", "rights", "kept", "here", "al", "right", "hers", "q"], k=rng.randint(1, 8))
        if rng.random() < 0.5:
            raw = list("all rights kept here")
            for _ in range(rng.randint(0, 4)):
                raw[rng.randrange(len(raw))] = rng.choice(["", "a", "rr"])
            words = words[:3] + "".join(raw).split() + words[3:]
        best = min(edits(" ".join(words[i:j]), notice.words) for i in range(len(words)) for j in range(i + 1, len(words) + 1))
        found = licenses.fuzzy(("\n " + " ".join(words) + "\n").encode(), [notice])
        assert bool(found) == (best <= 2) and (not found or min(e for _, _, e, _ in found) == best)
        hits += bool(found)
    assert 50 < hits < 250


NEGATIVE = {
    "licensed under cc by": "cc-by", "Licensed under CC BY 4.0.": "cc-by", "licensed under cc by us": "", "licensed under cc by xx": "", "licensed under cc bx nc": "",
    "licensed under CC BY-NC 4.0": "cc-by-nc", "licensed under cc by nc sa": "cc-by-nc,cc-by-nc-sa", "licensed under CC BY-ND": "cc-by-nd", "lisensed under CC BY-SA": "cc-by-sa",
    "released under the BSD license": "bsd", "released under the MPL license": "", "released under the ISC license": "", "released under the kit license": "", "released undr the MIT license": "mit",
    "Apache License, Version 1.1": "", "Apache Licence, Version 2.0": "apache-2", "Apache License, Version 3": "", "Mozilla Public License Version 1.1": "", "Mozilla Public Licence Version 2.0": "mpl-2",
    "GNU Affero General Public License": "agpl", "GNU Lesser General Public License": "lgpl", "new general public license": "", "all rights preserved": "", "all right reserved": "all-rights-reserved",
    "GNU General Public Licence": "gpl", "under the summit license": "",
}


def test_licences_are_told_apart(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(NEGATIVE)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(df).collect()}
    assert {t: got[i] for i, t in enumerate(NEGATIVE)} == NEGATIVE
