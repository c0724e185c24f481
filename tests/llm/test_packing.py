import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lowfold.llm import packing


def fewest(pieces, capacity):
    """Bins of the best packing, by trying everything."""
    best = [len(pieces)]
    pieces = sorted(pieces, reverse=True)

    def put(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(pieces):
            best[0] = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= pieces[k] and room not in rooms[:i]:
                put(k + 1, [*rooms[:i], room - pieces[k], *rooms[i + 1 :]])
        put(k + 1, [*rooms, capacity - pieces[k]])

    put(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_as_few_bins_as_there_can_be(seed):
    draw = random.Random(seed)
    pieces = [draw.randint(3, 20) for _ in range(draw.randint(1, 9))]
    plan = packing.solve(dict(Counter(pieces)), 20)
    assert Counter(x for n, f in plan for x in f for _ in range(n)) == Counter(pieces)
    assert all(sum(f) <= 20 for _, f in plan)
    assert sum(n for n, _ in plan) == fewest(pieces, 20)


def test_large_histogram_stays_near_the_bound():
    draw = np.random.default_rng(1)
    counts = Counter(np.minimum(2048, draw.lognormal(5.5, 1.2, 200_000).astype(int) + 1).tolist())
    plan = packing.solve(dict(counts))
    made = Counter()
    for n, filling in plan:
        for length in filling:
            made[length] += n
    assert made == counts
    bins, bound = sum(n for n, _ in plan), packing.lower_bound({k: v for k, v in counts.items() if k < 2048}, 2048) + counts[2048]
    assert bins <= 1.002 * bound + 1


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(packing.tokenizer_json())


def test_word_by_word_ids_are_those_of_the_text(reference):
    encoder = packing.Encoder(packing.tokenizer_json())
    draw = random.Random(5)
    signs = "aAbZé'’.,!#*-_=<|> \t\n\v  0١²ßİIΣς…̸́ 中文K"
    words = ["don't", "<|endoftext|>", "<|STARTOFTEXT|>", "it's", "'S", "x'll", "!!!", "Word###", "word.", "ÉTÉ***"]
    texts = ["".join(draw.choice(signs) if draw.random() < 0.85 else draw.choice(words) for _ in range(draw.randint(0, 16))) for _ in range(4000)]
    for text, code in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(code, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_are_looked_up_once_for_all_texts(reference, monkeypatch):
    """However often a word comes, texts are encoded together by their different words, also while words are forgotten."""
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    looked = []

    class Known(dict):
        def get(self, word, other=None):
            looked.append(word)
            return super().get(word, other)

    encoder = packing.Encoder(packing.tokenizer_json())
    encoder.known = Known()
    texts = ["one two, one" * 50, None, "", " \x0b\x0c two", "One\x85 \x1cé. 3.5 don't", "one <|endoftext|> One"]
    for k in range(4):
        got = encoder.encode([*texts, f"new{k} words{k}"])
        want = [reference.encode(t or "", add_special_tokens=False).ids for t in [*texts, f"new{k} words{k}"]]
        assert [np.frombuffer(code, "<u4").tolist() for code in got] == want
        if k == 0:
            assert looked and len(looked) == len(set(looked))
    assert encoder.encode([]) == []


def test_batches_are_encoded_together(reference, monkeypatch):
    """Words are looked up once for many batches, none of which is lost, repeated or reordered."""
    looked = []

    class Known(dict):
        def get(self, word, other=None):
            looked.append(word)
            return super().get(word, other)

    batches = [pa.record_batch([pa.array([k, None], pa.int64()), pa.array([f"Common words, and word{k % 7}.", None if k % 2 else ""])], names=["doc_id", "text"]) for k in range(40)]
    rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    for size in (packing.GATHERED, 1000, 1):
        monkeypatch.setattr(packing, "GATHERED", size)
        encoder = packing.Encoder(packing.tokenizer_json())
        encoder.known = Known()
        looked.clear()
        groups = [(ids.to_pylist(), texts.to_pylist(), encoder.encode(texts)) for ids, texts in packing._gathered(iter(batches))]
        assert [(i, t) for ids, texts, _ in groups for i, t in zip(ids, texts, strict=True)] == [(i, t if t is None else t.encode()) for i, t in rows]
        want = [reference.encode(t or "", add_special_tokens=False).ids for _, t in rows]
        assert [np.frombuffer(code, "<u4").tolist() for _, _, codes in groups for code in codes] == want
        if size > 1000:
            assert len(groups) == 1 and len(looked) == len(set(looked))
        else:
            assert len(groups) > 1
    assert list(packing._gathered(iter([]))) == []


def test_arrow_texts_keep_to_themselves(reference):
    """Parts of arrays, null texts, letters before a text's first sign, special tokens beside plain texts."""
    texts = ["skip.", None, "a", ".b,", "", "c.D <|endoftext|>E.f", "!", "Zé.x", None, "(g)", "<|STARTOFTEXT|>.", "h\x85.", "skip"]
    want = [reference.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder = packing.Encoder(packing.tokenizer_json())
    for kind in (pa.string(), pa.large_string(), pa.large_binary()):
        for a, b in ((0, 13), (1, 12), (4, 5), (8, 9), (5, 5)):
            codes = encoder.encode(pa.array(texts, pa.string()).cast(kind).slice(a, b - a))
            assert [np.frombuffer(code, "<u4").tolist() for code in codes] == want[a:b]


def test_pieces_and_places(odd_docs, reference):
    rows = packing.pack(odd_docs, capacity=512).collect()
    want = Counter()
    for r in odd_docs.collect():
        ids = np.asarray([*reference.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 512)):
            part = ids[start : start + 512]
            want[r.doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512


def test_no_documents(no_docs):
    assert packing.pack(no_docs).count() == 0
