"""The pieces of a public SentencePiece model file, read on the driver."""

from __future__ import annotations

from dataclasses import dataclass

#: A public vocabulary; every operator takes another path as a parameter.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"


@dataclass(frozen=True)
class Pieces:
    """Ordinary pieces with ids and scores, the ids of the 256 byte pieces, and the id of unknown."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes: list[int]
    unknown: int
    size: int


def load(path: str = PIECES) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, single = {}, {}, [-1] * 256
    for k in range(model.vocab_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            single[int(piece[1:-1], 16)] = k
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            ids[piece], scores[piece] = k, model.get_score(k)
    # Marker runs carry a placeholder far below all others, beside which sums would lose the rest.
    lowest = min((x for x in scores.values() if x > -1e8), default=0.0)
    scores = {piece: max(x, lowest) for piece, x in scores.items()}
    return Pieces(ids, scores, single, model.unk_id(), model.vocab_size())
