"""Reading the pieces of a public SentencePiece model file."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

#: The default vocabulary; every operator takes the path as a parameter.  The driver alone reads the file.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Fixed values of the file format: piece types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, i
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(data, i)
        else:
            if kind == 2:
                n, i = _varint(data, i)
            else:
                n = 4 if kind == 5 else 8
            value = data[i : i + n]
            i += n
        yield key >> 3, value


@dataclass(frozen=True)
class Pieces:
    """Pieces by id, with their scores and types."""

    text: tuple[str, ...]
    score: tuple[float, ...]
    kind: tuple[int, ...]
    dummy_prefix: bool

    @property
    def unknown(self) -> int:
        return self.kind.index(UNKNOWN)


def read_pieces(path: str = MODEL) -> Pieces:
    with open(path, "rb") as file:
        data = file.read()
    text, score, kind, prefix = [], [], [], True
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            text.append(own[1].decode())
            score.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            kind.append(own.get(3, NORMAL))
        elif number == 3:
            prefix = bool(dict(_fields(value)).get(3, 1))
    return Pieces(tuple(text), tuple(score), tuple(kind), prefix)
