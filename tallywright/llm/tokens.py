"""Token ids of whole texts by the tokenizers library."""

import os
import re
import string
import struct

END_ID = 0
VOCABULARY = "byte_bpe_50k.json"

# Pieces a worker remembers between texts, newer and older ones; about 200 bytes each.
REMEMBERED = 400_000

_TOUCHING = re.compile(r"\s\s")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_LONE_NEWLINE = re.compile(r"(?<=\S)\n(?=\S)")
_MARKS = string.punctuation


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_FORMATS = [struct.Struct(f"<{n}I") for n in range(64)]


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    n = len(ids)
    return _FORMATS[n].pack(*ids) if n < 64 else struct.pack(f"<{n}I", *ids)


def byte_letters() -> dict[int, str]:
    """How the byte-level splitter writes a byte: itself if it is printable, else the next free letter."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + n) for n, byte in enumerate(hidden)}


class _Pieces(dict):
    """Piece of a text -> its packed ids, encoded when it is first seen.

    When `REMEMBERED` pieces are held they become the older ones, and those before them go; an older
    piece that is asked for is a newer one again. So frequent pieces stay, and memory is bounded.
    """

    def __init__(self, tokenizer, lead: str):
        super().__init__()
        self.tokenizer, self.lead, self.letters = tokenizer, lead, byte_letters()
        self.written_lead = lead.translate(self.letters)
        self.model = tokenizer.model
        self.marks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self._encoded(piece)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found

    def _encoded(self, piece: str) -> bytes:
        if piece.isalpha():
            # One word to the splitter, so the library's merges apply to it directly.
            ascii_ = piece.isascii()
            letters = piece if ascii_ else piece.encode().decode("latin-1").translate(self.letters)
            return packed([token.id for token in self.model.tokenize(self.written_lead + letters)])
        word = piece.rstrip(_MARKS)
        if word.isalpha():
            # Marks after a letter are a word of their own to the splitter.
            marks = piece[len(word) :]
            if marks not in self.marks:
                if len(self.marks) >= REMEMBERED:
                    self.marks.clear()
                self.marks[marks] = self._library(marks)
            return self[word] + self.marks[marks]
        return self._library(self.lead + piece)


class Encoder:
    """Encodes a text piece by piece.

    The byte-level splitter always starts a new word at a space that stands alone between two other
    characters, and makes a new line that does so a word of its own, so a text may be cut there: the
    ids of the pieces, one after another, are the ids of the text. Words repeat, hence each piece is
    given to the library once. A text that holds one of the added tokens is encoded in one call.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The first piece of a line has no space before it.
        self.first, self.rest = _Pieces(self.tokenizer, ""), _Pieces(self.tokenizer, " ")
        self.new_line = packed(self.tokenizer.encode("\n", add_special_tokens=False).ids)

    def encode(self, text: str, end: bytes = packed([END_ID])) -> bytes:
        """All ids of `text`, then `end`, four bytes each."""
        if any(token in text for token in self.added):
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids) + end
        apart = not _TOUCHING.search(text)
        out, known = [], self.rest.__getitem__
        for line in text.split("\n") if apart else _LONE_NEWLINE.split(text):
            pieces = line.split(" ") if apart else _LONE_SPACE.split(line)
            out.append(self.first[pieces[0]])
            out.extend(map(known, pieces[1:]))
            out.append(self.new_line)
        out[-1] = end
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
