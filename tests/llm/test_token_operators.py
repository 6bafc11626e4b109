"""Operators 2, 6 and 9 against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, token_counts, tokenbin
from tidemark.llm.common import prepare
from tidemark.llm.vocab import Encoder, vocabulary

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
ODD = ["", " ", "a  b", " x", "x \n y", "don't  'll 12 34  a\n\n b", "é ñ  z  w \x1c k", "<|endoftext|> a <|endoftext|>",
       " ́a b", "A\tB \r\n C", "ΑΣ ΣΑΣ. Σ İstanbul", "²³¼ ªº µ ×÷", "日本語 テキスト", "😀 x😀y", "  nb sp ­-", "x" * 3000,
       "end <|endoftext|> start", "a<|endoftext|>b <|startoftext|>c", "<|ENDOFTEXT|> <|EndOfText|> A<|", "<|endoftext|>  <|endoftext|>\n",
       "É<|startoftext|> É X <|endoftext|>.", " <|endoftext|> ", "'s 're 'RE we've", "a b c", "﻿bom text", "word, word. word!"]


def library(name):
    tok = Tokenizer.from_file(vocabulary(name))
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name, cut", [(BYTE, "byte"), (WORD, "word")])
def test_pieces_encode_like_whole_texts(monkeypatch, name, cut):
    from tidemark.llm import vocab

    monkeypatch.setattr(vocab, "MAX_REMEMBERED", 50)
    rng = random.Random(1)
    parts = [*ODD, "<|endoftext|>", "<|startoftext|>", "<|", "|>", "the", " ", "  ", "\n", "word", "É", "12", "'s", ".", "\t"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    whole = library(name)
    for t, ids in zip(texts, Encoder(vocabulary(name), cut)(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole(t), repr(t)


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 20, 32])
def test_bits_round_trip(width):
    ids = np.random.default_rng(0).integers(0, 2 ** width, 1001, dtype=np.uint64).astype(np.uint32)
    packed = tokenbin.pack(ids, width)
    assert len(packed) == -(-1001 * width // 8)
    for start, count in ((0, 1001), (7, 100), (1000, 1), (500, 0)):
        assert (tokenbin.unpack(packed, width, start, count) == ids[start:start + count]).all()


def rows():
    out = [(i, t) for i, t in enumerate(ODD)] + [(2, ODD[2]), (2, "another text"), (None, "no id"), (50, None)]
    return out + [(100 + i, "many words in a long text " * 40 * (i % 5)) for i in range(30)]


def frame(spark):
    prepare(spark)
    df = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3)
    return df.withColumns({"n_tokens": F.lit("x"), "_text": F.lit(1), "start": F.lit(2.5)})


def test_blocks_hold_all_documents_in_order(spark, monkeypatch):
    monkeypatch.setattr(tokenbin, "BLOCK_IDS", 500)
    got = tokenbin.documents_in(tokenbin.token_table(frame(spark))).collect()
    got.sort(key=lambda r: r.start)
    whole = library(BYTE)
    want = Counter((d, zlib.crc32(np.array(whole(t) + [0], "<u4").tobytes())) for d, t in rows())
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    ids = [r.doc_id if r.doc_id is not None else -1 for r in got]
    assert ids == sorted(ids)
    assert tokenbin.documents_in(tokenbin.token_table(frame(spark).limit(0))).count() == 0


def test_differencing_splits_evenly():
    rng = random.Random(2)
    sizes = [rng.randint(1, 500) for _ in range(300)]
    split = packing.differencing(sizes, 40)
    assert sorted(i for w in split for i in w) == list(range(300))
    sums = [sum(sizes[i] for i in w) for w in split]
    assert max(sums) - min(sums) <= 60
    assert packing.differencing([], 3) == [[], [], []]
    full = packing.windows(sizes, 600)
    assert max(sum(sizes[i] for i in w) for w in full) <= 600 and sorted(i for w in full for i in w) == list(range(300))


def test_packing_places_every_id_once(spark):
    got = packing.pack_documents(frame(spark), capacity=256).collect()
    whole = library(WORD)
    want = defaultdict(list)
    for d, t in rows():
        want[d].append(np.array(whole(t) + [1], "<u4"))
    windows = defaultdict(list)
    pieces = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append(r)
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert 0 < at <= 256
    for d, texts in want.items():
        count = Counter()
        for ids in texts:
            for start, length in packing.cuts(len(ids), 256):
                count[start, length, zlib.crc32(ids[start:start + length].tobytes()), len(ids)] += 1
        assert count == Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got if r.doc_id == d)
    assert packing.pack_documents(frame(spark).limit(0)).count() == 0


def test_trees_follow_edits(monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF", 3)
    enc, whole = Encoder.load(vocabulary(BYTE), "byte"), library(BYTE)
    rng = random.Random(1)
    parts = ["a", "bc", " ", "  ", "\n", "'s", "é", "12", ".", "word", " x", " yy"]
    some = lambda n: "".join(rng.choice(parts) for _ in range(rng.randint(0, n)))
    saved = 0
    for _ in range(1500):
        text, edits, at = some(80), [], 0
        chars, tokens = (token_counts.tree_of(x) for x in token_counts.leaves(enc, text))
        assert chars[1] == len(text) and tokens[1] == len(whole(text))
        for _ in range(rng.randint(0, 4)):
            if at > len(text):
                break
            s = rng.randint(at, len(text))
            e = rng.randint(s, min(len(text), s + rng.choice([0, 1, 3, 10])))
            edits.append({"start": s, "end": e, "text": some(3)})
            at = e + (s == e)
        done = token_counts.apply(enc, text, chars, tokens, list(edits))
        new, at = "", 0
        for e in edits:
            new, at = new + text[at:e["start"]] + e["text"], e["end"]
        assert tokens[1] == len(whole(new + text[at:]))
        saved += done < np.count_nonzero(chars[len(chars) // 2:])
    assert saved > 300


def test_counts_of_a_table_with_edits(spark):
    edits = spark.createDataFrame([(2, 0, 1, "zz"), (2, 2, 2, " q"), (105, 0, 10 ** 6, None)],
                                  "doc_id long, start long, end long, text string")
    docs = token_counts.attach_edits(frame(spark).drop("n_tokens"), edits)
    got = token_counts.edited_counts(token_counts.with_trees(docs))
    assert {"n_tokens", "n_tokens_after", "tree_tokens", "start"} <= set(got.columns)
    whole = library(BYTE)
    after = {2: lambda t: "zz" + t[1:2] + " q" + t[2:], 105: lambda t: ""}
    want = Counter((d, len(whole(t)), len(whole(after.get(d, lambda x: x)(t or "")))) for d, t in rows())
    assert Counter((r.doc_id, r.n_tokens, r.n_tokens_after) for r in got.collect()) == want
    clash = frame(spark).withColumn("edits", F.lit(None).cast(token_counts.EDITS))
    assert token_counts.edited_counts(token_counts.with_trees(clash)).filter("n_tokens <> n_tokens_after").count() == 0


def test_a_word_is_encoded_once_whatever_mark_follows():
    from tidemark.llm import vocab

    for file, cut in (("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")):
        enc = vocab.Encoder(vocab.vocabulary(file), cut)
        asked, real = [], enc.tokenize
        enc.tokenize = lambda s: asked.append(s) or real(s)
        texts = ["x morning morning, morning. Übung, Übung. a, , . ,. .,", "x morning,, <|endoftext|>, <|endoftext|>."]
        assert [list(np.frombuffer(b, "<u4")) for b in enc(texts)] == [
            enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert sum("morning" in s for s in asked) <= 2  # the word, and once before two marks
    vocab.Encoder.load(vocab.vocabulary(file), cut)
    vocab.forget()
    assert not vocab._loaded


def test_words_beside_line_ends_are_remembered():
    from tidemark.llm import vocab

    for file, cut in ((BYTE, "byte"), (WORD, "word")):
        enc = vocab.Encoder(vocab.vocabulary(file), cut)
        asked, real = [], enc.tokenize
        enc.tokenize = lambda s: asked.append(s) or real(s)
        texts = [f"a{end}morning, x{end}Morning.{end}morning" for end in ("\n", "\n\n", ".\n", ",\n\n")]
        texts += ["\nmorning", "morning\n", "a\n\n\nmorning", "a\nb <|endoftext|>\n\n<|endoftext|>", "É.\nÉ\nñ,\n.\n\n9"]
        assert [list(np.frombuffer(b, "<u4")) for b in enc(texts[:4])] == [
            enc.tok.encode(t, add_special_tokens=False).ids for t in texts[:4]]
        assert sum("orning" in s for s in asked) <= 4  # in two cases, and twice before two marks
        for t in texts:
            assert list(np.frombuffer(enc([t])[0], "<u4")) == enc.tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_memory_bound_of_the_last_caller():
    from tidemark.llm import vocab

    words = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(300))]
    for most, held in ((10, 10), (1000, 300)):
        vocab.forget()
        enc = Encoder.load(vocabulary(WORD), "word", most)
        whole = enc(words)
        assert len(enc.known) <= max(most, held) and (most < 300 or len(enc.known) == 300)
        assert Encoder.load(vocabulary(WORD), "word") is enc and enc.known.most is None and enc(words) == whole
    vocab.forget()
