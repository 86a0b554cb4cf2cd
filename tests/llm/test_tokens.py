"""Token files, byte-pair encoding and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ALPHABET, documents, read_rows
from tokenizers import Tokenizer

from quillrank.llm import encoding, forcedbpe, packing, tokenfiles
from quillrank.llm.encoding import BYTE_BPE, WORD_BPE, byte_encoder, vocabulary_path
from quillrank.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(vocabulary_path(BYTE_BPE))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(vocabulary_path(WORD_BPE))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 9))) for _ in range(count)]


@pytest.mark.parametrize("width", [2, 4])
def test_byte_encoder_equals_the_library(byte_library, width):
    encode = byte_encoder(BYTE_BPE, width)
    for text in random_texts(1, 4000):
        assert np.frombuffer(encode(text), dtype=f"<u{width}").tolist() == ids_of(byte_library, text), repr(text)


def test_byte_encoder_keeps_one_model(byte_library, monkeypatch):
    encoding.load_tokenizer(vocabulary_path(BYTE_BPE))
    monkeypatch.setattr(encoding.json, "load", None)  # the vocabulary is not read a second time
    encode = encoding.ByteEncoder(vocabulary_path(BYTE_BPE), 2)
    for text in ["a  b", "a b ", " a", "a \u3000b", "a <|endoftext|> b", "wörd, word.\nWord's"]:
        assert np.frombuffer(encode(text), dtype="<u2").tolist() == ids_of(byte_library, text), repr(text)


def test_texts_encoded_together_equal_the_library(byte_library, monkeypatch):
    monkeypatch.setattr(encoding, "TOGETHER_BYTES", 3000)
    monkeypatch.setattr(encoding, "KNOWN_PIECES", 40)  # pieces are forgotten and learned again
    encoder = encoding.ByteEncoder(vocabulary_path(BYTE_BPE), 2)
    marks = ["word.", "word###", "word'", "it's,", "(784)", "a.\nb", "a\n\nb", "a \nb", "a\n b", "a\tb", "\n", "", None, "x" * 5000]
    texts = [*random_texts(3, 4000), *marks, *(f"one {mark or ''} two" for mark in marks)]
    together = list(encoder.batches(pa.array(texts)))
    assert 3 < len(together) < 100
    got = [np.frombuffer(ids, dtype="<u2").tolist() for some in together for ids in some]
    assert got == [ids_of(byte_library, text) for text in texts]


def test_many_lines_without_spaces(byte_library):
    text = "漢字。\n" * 3000 + "end"
    assert np.frombuffer(byte_encoder(BYTE_BPE, 2)(text), dtype="<u2").tolist() == ids_of(byte_library, text)


def test_words_reach_the_model_many_in_a_call(byte_library):
    encoder, calls, by_model = encoding.ByteEncoder(vocabulary_path(BYTE_BPE), 2), [], encoding.load_tokenizer(vocabulary_path(BYTE_BPE)).model.tokenize
    encoder._tokenize = lambda piece: calls.append(piece) or by_model(piece)
    letters = random.Random(4)
    text = " ".join("".join(letters.choices("abcdeéß", k=12)) + letters.choice(["", ".", "!!", "\nnext"]) for _ in range(2000))
    assert np.frombuffer(encoder(text), dtype="<u2").tolist() == ids_of(byte_library, text)
    assert len(calls) < 100


def test_forced_boundaries_equal_the_library(word_library):
    encoder = forcedbpe.encoder()
    for text in random_texts(2, 4000):
        packed, decoded = encoder.encode(text)
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        assert ids == ids_of(word_library, text), repr(text)
        assert decoded == word_library.decode(ids, skip_special_tokens=False)


def test_forced_cuts_are_pairs_of_no_token():
    encoder = forcedbpe.encoder()
    assert ("q", "z") not in encoder._joined
    assert not any("qz" in token for token in encoder._tokens.values())
    assert encoder._word("aqzb") == encoder._fragment("aq") + encoder._word("zb")


def test_token_files_query(spark, byte_library):
    found = {r.doc_id: r for r in LLM_QUERIES["op1_token_files"](spark, SF).collect()}
    start = 0
    rows = sorted(read_rows(SF, "documents"))
    assert len(found) == len(rows)
    for doc_id, text in rows:
        ids = [*ids_of(byte_library, text), 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert tuple(found[doc_id]) == (doc_id, start, len(ids), crc)
        start += len(ids)


def test_token_files_of_odd_rows_in_several_slices(spark, scratch, odd_documents, byte_library):
    store = scratch.path()
    tokenfiles.write_tokens(odd_documents, store, end_id=2, slice_ids=50)
    rows = tokenfiles.read_tokens(spark, store).collect()
    wanted = sorted((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in odd_documents.select("doc_id", "text").collect())
    got = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [doc if known else None for known, doc, _, _ in wanted]
    assert [np.frombuffer(r.ids, dtype="<u2").tolist() for r in got] == [[*ids_of(byte_library, t), 2] for *_, t in wanted]
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])))[:-1].tolist()


def test_token_files_can_be_mapped(spark, scratch, odd_documents):
    store = scratch.path()
    tokenfiles.write_tokens(odd_documents, store, end_id=2)
    for row in tokenfiles.bases(spark, store).collect():
        ids = np.memmap(row.path.removeprefix("file:"), dtype="<u2", mode="r")
        assert len(ids) == row.n_ids and ids[-1] == 2


def test_end_id_that_needs_wider_ids(scratch, odd_documents):
    assert tokenfiles.id_width(50_257, 2) == 2
    assert tokenfiles.id_width(50_257, 50_256) == 4
    with pytest.raises(ValueError, match="wider"):
        tokenfiles.write_tokens(odd_documents, scratch.path(), end_id=50_256, width=2)


def test_no_documents_give_nothing(spark, scratch, no_documents):
    store = scratch.path()
    tokenfiles.write_tokens(no_documents, store, end_id=2)
    assert tokenfiles.read_tokens(spark, store).isEmpty()
    assert packing.pack(no_documents, scratch).isEmpty()
    assert forcedbpe.encode_documents(no_documents).isEmpty()


def test_forced_encoding_of_odd_rows(odd_documents, word_library):
    wanted = sorted(map(repr, ((r.doc_id, ids_of(word_library, r.text)) for r in odd_documents.select("doc_id", "text").collect())))
    got = forcedbpe.encode_documents(odd_documents).collect()
    assert sorted(repr((r.doc_id, np.frombuffer(r.ids, dtype="<u4").tolist())) for r in got) == wanted


def check_packing(pieces, documents, library, window):
    """Each id in exactly one piece, sequences without gaps, none padded but where its length is a power of two."""
    by_sequence, by_document = {}, {}
    for piece in pieces:
        by_sequence.setdefault(piece.sequence_id, []).append(piece)
        by_document.setdefault(piece.doc_id, []).append(piece)
    for sequence in by_sequence.values():
        offset = 0
        for piece in sorted(sequence, key=lambda p: p.offset):
            assert piece.offset == offset and piece.length == len(piece.ids) // 2 > 0
            offset += piece.length
        assert offset == window or (offset < window and offset & (offset - 1) == 0)
    got, wanted = {}, {}
    for doc, own in by_document.items():
        got[doc] = sum(p.length for p in own)
    for doc, text in documents:
        wanted[doc] = wanted.get(doc, 0) + len(ids_of(library, text)) + 1
    assert got == wanted
    unique = [doc for doc, _ in documents]
    for doc, text in documents:
        if unique.count(doc) == 1:
            own = sorted(by_document[doc], key=lambda p: p.start)
            ids = [*ids_of(library, text), 1]
            assert np.frombuffer(b"".join(bytes(p.ids) for p in own), dtype="<u2").tolist() == ids
            assert all(p.doc_tokens == len(ids) for p in own)
            assert [p.start for p in own] == np.concatenate(([0], np.cumsum([p.length for p in own])))[:-1].tolist()


def test_packing_of_documents(spark, scratch, byte_library):
    rows = read_rows(SF, "documents")
    check_packing(packing.pack(documents(spark, SF), scratch).collect(), rows, byte_library, 2048)


@pytest.mark.parametrize("window", [16, 100])
def test_packing_of_odd_rows(scratch, odd_documents, byte_library, window):
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    if window == 16:
        rows = [r for r in rows if r[0] != 9]
        odd_documents = odd_documents.where("doc_id is null or doc_id <> 9")
    check_packing(packing.pack(odd_documents, scratch, window=window).collect(), rows, byte_library, window)


def test_index_ranks_by_bm25():
    idf = np.linspace(0.1, 5, 1 << 16).astype(np.float32)
    docs = [np.array(ids) for ids in ([1, 2, 60000], [60000, 60000, 7], [1, 2, 3], [9, 10])]
    shard = packing.Shard(docs, idf, 3.0)
    scores = {}
    for i, doc in enumerate(docs):
        scores[i] = sum(
            idf[t] * 2.2 * (doc == t).sum() / ((doc == t).sum() + 1.2 * (0.25 + 0.75 * len(doc) / 3)) for t in docs[0]
        )
    shard.take(0)
    assert shard.neighbours(0) == sorted((i for i in (1, 2) if scores[i]), key=lambda i: -scores[i])
    shard.take(1)
    assert shard.neighbours(0) == [2]


def test_a_seed_asks_with_all_its_tokens():
    """The best neighbour shares 30 light tokens, none of them among the heaviest; used documents are left out."""
    heavy, light = np.arange(100, 120, dtype=np.uint16), np.arange(200, 230, dtype=np.uint16)
    filler = np.arange(300, 329, dtype=np.uint16)
    docs = [np.concatenate((heavy, light)), np.concatenate((heavy[:1], filler)), light, filler]
    idf = np.zeros(1 << 16, dtype=np.float32)
    idf[heavy], idf[light], idf[filler] = 2, 1, 1
    shard = packing.Shard(docs, idf, 30.0)
    shard.take(0)
    assert shard.neighbours(0) == [2, 1]
    shard.take(2)
    assert shard.neighbours(0) == [1]
    shard.take(1)
    assert shard.neighbours(0) == []
