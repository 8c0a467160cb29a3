"""Pieces of a SentencePiece BPE vocabulary and its merge procedure."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

SPACE = "▁"
SHORT, NEVER = 40, float("-inf")
LONG_TEXT = 1_000_000
# A piece never continues after a blank that follows other characters, and no piece
# of several characters holds a line feed; so texts are cut there.
_CHUNKS = re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


class Pieces:
    """Vocabulary of a model with byte fallback, identity normalisation and a blank put in front."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [
            i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        if not all(model.is_byte(i) for i in self.byte_ids):
            raise ValueError("the model has no byte fallback")
        for p in self.ids:
            if SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1):
                raise ValueError(f"piece {p!r} crosses a chunk's end")
        self.joints = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.raw = {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()}
        self.raw.update({i: bytes([b]) for b, i in enumerate(self.byte_ids)})

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Parts of a text, a blank put in front, that are encoded one by one."""
        return _CHUNKS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    @staticmethod
    def each_chunk(text: str) -> Iterator[str]:
        """The same chunks, one at a time where the text is long."""
        if len(text) <= LONG_TEXT:
            return iter(Pieces.chunks(text))
        return (m.group() for m in _CHUNKS.finditer(SPACE + text.replace(" ", SPACE)))

    def cut(self, chunk: str) -> list[str]:
        """Parts of a chunk between neighbours that stand together in no piece.

        No merge can cross such a place, so the parts are encoded one by one.
        """
        joints, out, start = self.joints, [], 0
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in joints:
                out.append(chunk[start:i])
                start = i
        out.append(chunk[start:])
        return out

    def merge(self, symbols: list[str], skip: Callable[[int, int, int], bool] | None = None) -> list[str]:
        """Merge neighbours, the best score first and the leftmost among equals.

        Candidates wait in an agenda. ``skip`` is asked for each one when its turn
        comes, with its place and the two lengths, and may drop it; it returns only
        if one of its sides changes.
        """
        n = len(symbols)
        if n < 2:
            return symbols
        if n <= SHORT:
            return self._merge_short(symbols, skip)
        scores = self.scores
        parts: list = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            s = scores.get(parts[i] + parts[i + 1])
            if s is not None:
                agenda.append((-s, i, parts[i], parts[i + 1]))
        heapq.heapify(agenda)
        while agenda:
            _, i, left, right = heapq.heappop(agenda)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            if skip is not None and skip(i, len(left), len(right)):
                continue
            both = parts[i] = left + right
            parts[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                s = scores.get(both + parts[k])
                if s is not None:
                    heapq.heappush(agenda, (-s, i, both, parts[k]))
            h = before[i]
            if h >= 0:
                s = scores.get(parts[h] + both)
                if s is not None:
                    heapq.heappush(agenda, (-s, h, parts[h], both))
        return [p for p in parts if p is not None]

    def _merge_short(self, symbols: list[str], skip: Callable[[int, int, int], bool] | None) -> list[str]:
        """The same for few symbols: the agenda is the list of the neighbours' scores."""
        get, parts, at = self.scores.get, list(symbols), list(range(len(symbols)))
        agenda = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while agenda:
            best = max(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            if skip is not None and skip(at[i], len(parts[i]), len(parts[i + 1])):
                agenda[i] = NEVER
                continue
            parts[i] += parts.pop(i + 1)
            del at[i + 1], agenda[i]
            if i:
                agenda[i - 1] = get(parts[i - 1] + parts[i], NEVER)
            if i < len(agenda):
                agenda[i] = get(parts[i] + parts[i + 1], NEVER)
        return parts

    def to_ids(self, symbols: list[str]) -> list[int]:
        """Ids of symbols; characters outside the vocabulary become their bytes."""
        out = []
        for s in symbols:
            i = self.ids.get(s)
            if i is None:
                out.extend(self.byte_ids[b] for b in s.encode("utf-8"))
            else:
                out.append(i)
        return out
