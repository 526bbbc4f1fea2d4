import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from zonecast.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    tok, start, out = Tokenizer.from_file(PATH), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


TEXTS = [
    "The quick brown Fox, it's 42 years' old.\nNew\tline\r\n  two  spaces",
    "",
    None,
    "ÉCOLE Straße ΣΑΣ Σ. İstanbul ﬁ ｆｕｌｌ é ́x <|endoftext|>x<|startoftext|> don't you'LL",
    "a" * 5000 + " " + "b," * 300,
    " sep nbsp\x1cfs\x85nel " * 50,
    "日本語 テスト 123 !?.., ,.",
    "The quick brown Fox, it's 42 years' old.\nNew\tline\r\n  two  spaces",
]


def test_encoder_equals_library():
    tok, enc = Tokenizer.from_file(PATH), tf.CachedEncoder(PATH, keep=5)
    for _ in range(3):
        for t in TEXTS:
            got = np.frombuffer(enc.encode_many([(t or "").encode()])[0], enc.dtype).tolist()
            assert got == tok.encode(t or "", add_special_tokens=False).ids


def test_random_unicode_equals_library():
    """Marks, capitals that become several characters, jamo, digits of all scripts, each before full stops and commas."""
    rng = random.Random(11)
    odd = "İıßſŉǰΐẞﬁΣςσΆ" + "\u0301\u0307\u0308\u0345\u0323" + "".join(map(chr, range(0x1100, 0x1113))) + "".join(map(chr, range(0x1161, 0x1170))) + "한国語テ½²①Ⅷ٣Āå\u212b\u1e9b\u0130"
    letters = "abcXYZ" * 6 + "éüñÄÖ" * 3 + odd
    every = [c for c in map(chr, range(0x21, 0x30000)) if not 0xD800 <= ord(c) < 0xE000]
    tok, enc = Tokenizer.from_file(PATH), tf.CachedEncoder(PATH, keep=3000)
    for i in range(10_000):
        pool = letters if i % 4 else rng.choices(every, k=20)
        words = ["".join(rng.choices(pool, k=rng.randint(1, 6))) + rng.choice(["", "", ".", ",", "..", ".,", "'s", "!"]) for _ in range(rng.randint(1, 5))]
        t = rng.choice([" ", "\n", "  ", "\t"]).join(words)
        assert np.frombuffer(enc.encode_many([t.encode()])[0], enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t
    for t in ["TATİLİ.", "ev İYİ, güzel", "x<|ENDOFTEXT|> y<|endoftext|>Z."]:
        assert np.frombuffer(enc.encode_many([t.encode()])[0], enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("seq_len,rows", [(8, 1), (64, 8192), (1024, 8192)])
def test_round_trip(spark, scratch, seq_len, rows):
    data = [(i * 3 % 17, t) for i, t in enumerate(TEXTS * 4)] + [(None, "no id")]
    docs = spark.createDataFrame([(d, t, "s", 5) for d, t in data], "doc_id long, text string, path string, start int").repartition(3)
    m = tf.write_sequences(docs, PATH, scratch + "/t", seq_len, rows_per_file=rows)
    got = sorted((tuple(r) for r in tf.read_documents(m).collect()), key=lambda r: r[1])
    assert got == brute(data)
    total = sum(r[2] for r in got)
    seqs = tf.read_sequences(m).collect()
    assert sum(sum(r.mask) for r in seqs) == total
    assert all(len(r.ids) == seq_len and len(r.mask) == seq_len for r in seqs)


def test_empty_table(spark, scratch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    m = tf.write_sequences(docs, PATH, scratch + "/e")
    assert tf.read_documents(m).collect() == [] and tf.read_sequences(m).collect() == []


def test_views_share_the_file(spark, scratch):
    docs = spark.createDataFrame([(i, TEXTS[0]) for i in range(200)], "doc_id long, text string").coalesce(1)
    m = tf.write_sequences(docs, PATH, scratch + "/z", 16).collect()
    f = tf.SequenceFile.open(m[0].path)
    assert not f.sequence(3).flags.owndata and not f.mask_bits(3).flags.owndata
    assert len(f.sequence(m[0].n_rows - 1)) == 16
