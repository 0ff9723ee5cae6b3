"""Tokenizer files of the installed libraries: encoding, the bytes of each token, and what is proven of them.

``open_tokenizer(path)`` takes a ``.model`` (sentencepiece) or a ``.json`` (tokenizers) file.  Strings of
special tokens inside texts are ordinary text.  Each worker opens a file once.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np

#: White space of any Unicode version, controls and invisible characters, and the mark that stands for a space in
#: pieces: characters that no cut of a text may touch.  Fixed values.
GAP = r"\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff"


class Pieces:
    """A sentencepiece model.

    ``best_pair`` says that it encodes by merging the best pair first and the leftmost of equal ones, without changing
    the text but for marks of spaces; ``cuts_at_spaces`` that no piece crosses from another character to a space,
    so that what stands before a space and what follows are encoded alone as they are together.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        norm = proto.normalizer_spec
        plain = (norm.name == "identity" and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
                 and norm.add_dummy_prefix and not proto.trainer_spec.treat_whitespace_as_suffix)
        self.best_pair = bool(plain and proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
                              and not any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces))
        self.cuts_at_spaces = self.best_pair and not any(
            "\u2581" in p.piece.lstrip("\u2581") for p in proto.pieces if p.type == kind.NORMAL)
        self.size = len(proto.pieces)
        self.bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else p.piece.replace("\u2581", " ").encode()
                      for p in proto.pieces]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        # A list starts a thread: one text goes without.
        return [self.model.encode(texts[0])] if len(texts) == 1 else self.model.encode(texts, num_threads=1)

    def places(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and last byte offset of each token's own text (the space put before it begins at -1)."""
        if "\u2581" not in text:
            ids = np.array(self.model.encode(text), np.int64)
            size = self.lengths[ids]
            ends = np.cumsum(size) - 1
            if not len(ids) or ends[-1] == len(text.encode()):
                return ids, ends - size, ends
        found = self.model.encode(text, return_type="proto").pieces
        return tuple(np.array([getattr(p, x) for p in found], np.int64) for x in ("id", "begin", "end"))


class Words:
    """A file of the tokenizers library; ``cuts_at_spaces`` as above, by the byte-level split before a single space."""

    best_pair = False  # pieces never cross the file's own split, which looks ahead: whole texts only

    def __init__(self, path: str) -> None:
        # A worker is one of many on its machine: the library's own pool of threads would only wait beside it.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.cuts_at_spaces = bool(
            spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space", True) and spec["model"].get("type") == "BPE"
            and not spec["model"].get("dropout") and all(t["special"] for t in spec.get("added_tokens", [])))
        self.size = self.model.get_vocab_size()
        # The byte-level alphabet by its rule: printable bytes stand for themselves, the others follow 255 in order.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.bytes = []
        for i in range(self.size):
            token = self.model.id_to_token(i) or ""
            self.bytes.append(bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode())
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]


@functools.lru_cache(maxsize=4)
def open_tokenizer(path: str) -> Pieces | Words:
    return Pieces(path) if path.endswith(".model") else Words(path)
