"""Byte-pair encoding with forced boundaries, and its decoding.

Two neighbouring symbols that no token of the vocabulary holds next to each other can never be merged
across: every such pair is a certain cut. Words are cut there, and the fragments, which are short and
repeat, are encoded on their own and put together again. Merges inside a fragment are those of the
whole word, because merges never reach over a cut and their order by rank does not depend on what
stands beyond it.
"""

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quillrank.llm.encoding import WORD_BPE, byte_letters, load_tokenizer, special_tokens, vocabulary_path
from quillrank.llm.ids import id_or_mark, id_or_null
from quillrank.llm.worker import per_worker

CACHE = 400_000  # parts of texts that a worker remembers


class _Parts(dict):
    """Ids and decoded tokens by part of a text; a missing one is encoded and remembered.

    When half the limit is reached the parts become the old generation; what is used again moves up from there.
    """

    def __init__(self, encoded: Callable[[str], tuple[bytes, str]]):
        super().__init__()
        self._encoded, self._old = encoded, {}

    def __missing__(self, part: str) -> tuple[bytes, str]:
        found = self._old.get(part) or self._encoded(part)
        if len(part) < 64:
            if len(self) >= CACHE // 2:
                self._old = dict(self)
                self.clear()
            self[part] = found
        return found


class ForcedBoundaryEncoder:
    """Encodes and decodes as the tokenizer file at ``path`` says, without truncation and padding."""

    def __init__(self, path: str):
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        self._tokens = {i: token for token, i in vocabulary.items()}
        self._end = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # The merges of a fragment; only the last fragment of a word has the mark of the word's end.
        own = {"vocab": vocabulary, "merges": merges, "cache_capacity": 0}
        self._inner, self._last = BPE(**own), BPE(**own, end_of_word_suffix=self._end)
        self._joined = set()
        for token in vocabulary:
            symbols = self._symbols(token)
            self._joined.update(zip(symbols[:-1], symbols[1:], strict=True))
        self._specials = special_tokens(path)
        self._tokens |= {i: token for token, i in self._specials.items()}
        self._special = re.compile("(" + "|".join(map(re.escape, self._specials)) + ")") if self._specials else None
        library = load_tokenizer(path)
        self._normalizer, self._splitter = library.normalizer, library.pre_tokenizer
        self._letters = byte_letters()
        self._parts = _Parts(self._encoded)
        self._inner_fragments: dict[str, list[int]] = {}

    def _symbols(self, token: str) -> list[str]:
        """One symbol per byte; the mark of a word's end belongs to the last."""
        if self._end and token.endswith(self._end) and len(token) > len(self._end):
            body = token[: -len(self._end)]
            return [*body[:-1], body[-1] + self._end]
        return list(token)

    def _word(self, word: str) -> list[int]:
        """The ids of one word, written one letter per byte."""
        ids, start, joined = [], 0, self._joined
        for i in range(1, len(word)):
            right = word[i] if i < len(word) - 1 else word[i] + self._end
            if (word[i - 1], right) not in joined:
                ids += self._fragment(word[start:i])
                start = i
        return ids + [token.id for token in self._last.tokenize(word[start:])]

    def _fragment(self, symbols: str) -> list[int]:
        ids = self._inner_fragments.get(symbols)
        if ids is None:
            ids = [token.id for token in self._inner.tokenize(symbols)]
            if len(self._inner_fragments) >= CACHE:
                self._inner_fragments.clear()
            self._inner_fragments[symbols] = ids
        return ids

    def _plain(self, part: str) -> str | None:
        """The one word that a part of letters is, normalised; None if normalising leaves other than letters."""
        if not part.isalpha():
            return None
        if part.isascii():
            return part.lower()
        normal = self._normalizer.normalize_str(part)
        return normal.encode().decode("latin-1").translate(self._letters) if normal.isalpha() else None

    def _encoded(self, part: str) -> tuple[bytes, str]:
        word = self._plain(part)
        if word is not None:
            ids = self._word(word)
        elif part[-1] in ".," and self._plain(part[:-1]) is not None:
            # A mark after letters is a word of its own.
            (ids, text), (mark, mark_text) = self._parts[part[:-1]], self._parts[part[-1]]
            return ids + mark, f"{text} {mark_text}"
        else:
            words = self._splitter.pre_tokenize_str(self._normalizer.normalize_str(part))
            ids = [i for word, _ in words for i in self._word(word)]
        return np.array(ids, dtype="<u4").tobytes(), self.decode(ids)

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """The ids as little-endian 32-bit integers, and the text decoded from them.

        White space only separates words here, so parts between spaces or line ends are independent.
        """
        if not text:
            return b"", ""
        ids, decoded = [], []
        pieces = self._special.split(text) if self._special and "<|" in text else [text]
        for piece in pieces:
            if piece in self._specials:
                ids.append(np.array([self._specials[piece]], dtype="<u4").tobytes())
                decoded.append(piece)
                continue
            found = list(map(self._parts.__getitem__, filter(None, piece.replace("\n", " ").split(" "))))
            ids += [part_ids for part_ids, _ in found]
            decoded += [part_text for _, part_text in found if part_text]
        return b"".join(ids), " ".join(decoded)

    def decode(self, ids: list[int]) -> str:
        """The tokens with spaces between them: the vocabulary has no decoder that would join them."""
        return " ".join(self._tokens[i] for i in ids)


def encoder(name: str = WORD_BPE) -> ForcedBoundaryEncoder:
    path = vocabulary_path(name)
    return per_worker(f"forced {path}", lambda: ForcedBoundaryEncoder(path))


def encode_documents(documents: DataFrame, vocabulary: str = WORD_BPE) -> DataFrame:
    """(doc_id, ids, decoded): ids packed as 32-bit little-endian, one row per row of ``documents``.

    Null and empty texts, and those without words, give no ids and an empty string. A null doc_id stays null;
    repeated rows are encoded each; other columns are not read. Without shuffle.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode
        for frame in frames:
            found = [encode(text) for text in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "ids": [f[0] for f in found], "decoded": [f[1] for f in found]
            })

    encoded = documents.select(id_or_mark("doc_id"), "text").mapInPandas(
        rows, "doc_id bigint, ids binary, decoded string"
    )
    return encoded.withColumn("doc_id", id_or_null("doc_id"))
