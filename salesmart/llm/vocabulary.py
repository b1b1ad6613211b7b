"""The public piece vocabulary the language and encoding operators work over."""

from __future__ import annotations

from functools import lru_cache

import sentencepiece

#: A SentencePiece model file; every operator takes another path as an argument. Read on the driver only.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@lru_cache(4)
def pieces(path: str = PIECES) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind is text, byte, control, unknown or unused."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: ("control" if model.is_control(i) else "unknown" if model.is_unknown(i) else
                      "byte" if model.is_byte(i) else "unused" if model.is_unused(i) else "text")
    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.vocab_size())]
