import random
import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from newsloom.llm import packing, tokens

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = ["x" * 500, " \n  a\t\tb  ", "<|endoftext|> a<|endoftext|>b  it's 12ab3", "\xa0 foo\x1c !\x1c bar　 z", "é" * 300, "'s 't  \n\n x"]


def encode(path):
    tok = tokens.load_tokenizer(path)
    return lambda s: tok.encode(s, add_special_tokens=False)


def odd_texts(sf_dir, n=40):
    import pyarrow.parquet as pq

    rnd = random.Random(1)
    base = pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()[:n]
    return base + ODD + [rnd.choice(ODD).join(rnd.choices(ODD + base[:3], k=4)) for _ in range(n)]


ODD += ["a\xa0 b\u3000 c\u2003\td \x85\ne\x1c f", "T\u0308 H\u0331 caf\u00e9 o'clock don't 'S 12,5 $3", "\u0e01\u0e33 \u0915\u094d \U0001f600\U0001f468\u200d\U0001f469 \u65e5\u672c\u8a9e\u3002\u30c6\u30b9\u30c8\u3001abc", "\x01 \x01a b\x01", "x\r\n\r\ny \x0b z", "</w> a</w>b </w>", "I\u0130\u0130 \u00df \u03a3\u03c3\u03c2 \u01c5"]


def test_spliced_chunks_equal_whole_text(sf_dir):
    rnd, enc = random.Random(1), encode(BYTE)
    specials = tokens.special_strings(tokens.load_tokenizer(BYTE))
    for t in odd_texts(sf_dir):
        for _ in range(3):
            assert tokens.encode_spliced(enc, t, rnd.choice([50, 200, 1000]), rnd.choice([4, 16, 64]), specials) == enc(t).ids


def test_chunks_end_anywhere_in_a_special_string():
    """White space in front of a special string is parted otherwise than in front of other signs."""
    enc, special = encode(BYTE), ["<|endoftext|>"]
    for blanks in ("", " ", "  ", "\n\n", " \n", "\n \n", "\u00a0 "):
        for place in range(340, 420):
            t = ("plain words, " * 40)[:place] + blanks + "<|endoftext|>" + blanks + "more of it. " * 60
            assert tokens.encode_spliced(enc, t, 400, 16, special) == enc(t).ids, (blanks, place)
    rnd = random.Random(5)
    bits = ["<|endoftext|>", "<|endoftext|>", " ", "  ", "\n", "\n\n", "\t", "word", "'s", "12", "!", "<|endo", "é日", "<|", "|>"]
    for _ in range(400):
        t = "".join(rnd.choices(bits, k=rnd.randint(100, 600)))
        assert tokens.encode_spliced(enc, t, rnd.choice([60, 100, 400]), rnd.choice([4, 16]), special) == enc(t).ids


def test_special_strings_at_the_end_of_default_chunks(spark):
    prose = "It was plain prose, and it went on. " * 3000
    rows = [(i, prose[: tokens.CHUNK - 20 + i] + "\n\n<|endoftext|>" + prose[:30_000]) for i in range(30)]
    enc = encode(BYTE)
    got = tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), BYTE).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(enc(t).ids) for i, t in rows}


def test_segments_have_the_ids_of_whole_texts(sf_dir):
    import pyarrow as pa

    texts = [None, "", *odd_texts(sf_dir)]
    own, first = tokens.segments_of(pa.array(texts))
    assert "".join(own.to_pylist()) == "".join(t or "" for t in texts) and first[-1] == len(own)
    tok, enc = tokens.load_tokenizer(BYTE), encode(BYTE)
    for limit in (20, 10**6):
        got = tokens.segment_counts(pa.array(texts).slice(1), tokens.count_cache(tok, limit))
        assert got.tolist() == [len(enc(t).ids) for t in texts[1:]]
    tok, enc = tokens.load_tokenizer(WORD), encode(WORD)
    ids, begin = packing.token_ids(pa.array(texts), packing.id_cache(tok), 7)
    for i, t in enumerate(texts):
        assert ids[begin[i] : begin[i + 1]].tolist() == enc(t or "").ids + [7], t


def test_piece_counts_are_the_libraries(sf_dir):
    """Every character that counts as plain: alone, doubled, after a letter, a digit and a sign."""
    tok = tokens.load_tokenizer(WORD)
    plain = np.flatnonzero(packing._PLAIN).tolist()
    words = [f(chr(c)) for c in plain if c > 32 and (c < 0x460 or c % 97 == 0) for f in (str, lambda x: x + x, lambda x: "a" + x, lambda x: "1" + x, lambda x: "." + x)]
    n = packing.pieces_of(words)
    assert n.all()
    for w, k in zip(words, n.tolist(), strict=True):
        assert len(tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(w))) == k, w


def test_splicing_encodes_a_bounded_multiple_of_the_text():
    enc, seen = encode(BYTE), []

    def counted(s):
        seen.append(len(s))
        return enc(s)

    japanese = "\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059\u3002\u6b21\u306e\u6587\u3001" * 12_000
    for t in (japanese, "a" * 300_000, " " * 300_000, ("b" * 70_000 + "1") * 4, "\u65e5" * 200_000):
        seen.clear()
        assert tokens.encode_spliced(counted, t, 16_384) == enc(t).ids
        assert sum(seen) <= 3 * len(t)


def edge_docs(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "one two", None), (4, "one two", "x"), (4, "one two", "x"), (5, ODD[2] + " y" * 5000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts_match_the_library(spark, sf_dir):
    enc = encode(BYTE)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for d, chunk in ((docs, 1000), (edge_docs(spark), 2000)):
        got = tokens.count_tokens(d, BYTE, chunk=chunk, overlap=16).collect()
        want = sorted(((r.doc_id, len((r.text or "").encode()), len(enc(r.text or "").ids)) for r in d.collect()), key=str)
        assert sorted(map(tuple, got), key=str) == want
    assert tokens.count_tokens(docs.limit(0), BYTE).count() == 0


def test_packing_round_trip(spark, sf_dir):
    enc = encode(WORD)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).unionByName(edge_docs(spark), allowMissingColumns=True)
    got = packing.pack_documents(docs, WORD, capacity=300, with_ids=True).cache()
    rows = got.collect()
    want = []
    for r in docs.collect():
        ids = np.array(enc(r.text or "").ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), 300)):
            own = ids[at : at + 300]
            want.append((r.doc_id, k, at, len(own), zlib.crc32(own.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    out = {r.sequence_id: bytes(r.ids) for r in packing.assemble(got).collect()}
    for s, parts in by.items():
        parts.sort()
        at = 0
        for o, n, _ in parts:
            assert o == at
            at += n
        assert at <= 300
        assert out[s] == b"".join(x for _, _, x in parts)
    assert packing.pack_documents(docs.where(F.lit(False)), WORD).count() == 0


def test_letters_that_compose_in_lower_case_only(spark):
    import unicodedata

    enc = encode(WORD)
    five = ["T\u0308", "H\u0331", "W\u030a", "Y\u030a", "J\u030c"]
    texts = [*five, "The " + " ".join(five) + " END", "T\u0331\u0308 J\u0f71\u030c W\u0344 X\u0344"]
    texts += [" ".join(chr(c) + chr(m) for c in [*range(65, 91), *range(97, 123)]) for m in range(0x300, 0x370)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack_documents(docs, WORD).collect()}
    for i, t in enumerate(texts):
        ids = np.array(enc(t).ids + [0], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), t
    for m in filter(lambda m: not 0xD800 <= m < 0xE000, range(0x80, 0x110000)):
        if chr(m).encode()[0] not in (0xCC, 0xCD):
            for c in "thwyj":
                assert unicodedata.normalize("NFC", c + chr(m))[0] == c


def test_plans_are_whole_and_near_the_bound():
    rnd = random.Random(3)
    for _ in range(200):
        capacity = rnd.choice([10, 20, 50, 2048])
        counts = {}
        for _ in range(rnd.randint(0, 60)):
            k = rnd.randint(1, capacity)
            counts[k] = counts.get(k, 0) + rnd.randint(1, 9)
        plan = packing.plan_packing(counts, capacity)
        held = {}
        for length, _, n, s, each, offset in plan.rows:
            for r in range(n):
                held.setdefault(s + r // each, []).append((offset + r % each * length, length))
        for x in held.values():
            end = 0
            for o, n in sorted(x):
                assert o == end
                end += n
            assert end <= capacity
        assert sum(map(len, held.values())) == sum(counts.values())
        bound = packing.lower_bound(counts, capacity)
        assert bound <= plan.sequences <= 1.25 * bound + 1


def test_dominance_fixes_exact_pairs():
    plan = packing.Plan(10)
    assert packing.reduce_dominated({10: 2, 7: 3, 3: 3}, plan) == {}
    assert plan.sequences == 5
