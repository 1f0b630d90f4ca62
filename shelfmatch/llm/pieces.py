"""The piece table of a SentencePiece BPE model, and what follows from it.

Facts used by the operators (checked on loading): the normaliser is the identity with a dummy prefix, no piece
holds the space mark after another character, and characters without a piece fall back to bytes.  Then

* a text may be cut into units that merge on their own wherever no piece holds the two characters at the cut;
* a segmentation is the model's own if and only if each two neighbours are the model's own segmentation of
  their joined text, so the last piece of every prefix of a unit is unique, and ``pair`` decides it.
"""

from __future__ import annotations

import re

SPACE = "▁"
LETTERS = "A-Za-zÀ-ɏ"


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unknown = sp.unk_id()
        self.text = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.byte_id = {int(self.text[i][3:5], 16): i for i in range(len(self.text)) if sp.is_byte(i)}
        self.id = {p: i for i, p in enumerate(self.text) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.longest = max(map(len, self.id))
        if len(self.byte_id) != 256 or any(SPACE in p.lstrip(SPACE) for p in self.id) or any(c not in self.id for p in self.id for c in p):
            raise ValueError("the model is no BPE model with byte fallback whose pieces hold the space mark in front only")
        self.prefixes = {p[:k] for p in self.id for k in range(1, len(p))}
        #: A unit: spaces and what follows them up to the next space or line end, or up to the end of a run of letters
        #: if no piece goes on behind one.
        cut = "" if "\n" in self.id else "\n"
        letters, after = f"[{LETTERS}]", re.compile(f"[{LETTERS}][^{LETTERS}]")
        whole = f" +[^ {cut}]*|[^ {cut}]+"
        parts = f" *[^ {cut}{LETTERS}]*{letters}+| +[^ {cut}{LETTERS}]*|[^ {cut}{LETTERS}]+"
        self.units = re.compile((whole if any(after.search(p) for p in self.id) else parts) + (f"|{cut}" if cut else ""))
        self._pairs: dict[tuple[str, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """The model's merges: of all neighbours that join to a piece the best score, the leftmost of equals."""
        score = self.score
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def pair(self, a: str, b: str) -> bool:
        """Whether pieces ``a`` and ``b`` stay apart when the model segments their joined text."""
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) > 400_000:  # a table of this size is dropped and filled anew
                self._pairs.clear()
            found = self._pairs[a, b] = self.merged(list(a + b)) == [a, b]
        return found

    def fallback(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode()]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
