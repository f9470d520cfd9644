"""Agendas of many units are worked off in few array steps, with the ids of the heap."""

from __future__ import annotations

from martloom.llm.pieces import LONGEST_KEPT, Encoder, Pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def test_one_lookup_a_round_and_the_heap_agrees(monkeypatch):
    pieces = Pieces(MODEL)
    units = ["▁" + w for w in ("recommendation", "a", "ab", "naïveté", "日本語テキスト", "zzzzqqqq", "internationalisation", "x" * (LONGEST_KEPT - 1))]
    calls, own = [], Pieces.look

    def counted(self, a, b):
        calls.append(len(a))
        return own(self, a, b)

    monkeypatch.setattr(Pieces, "look", counted)
    for dropout in (0.0, 0.3):
        enc = Encoder(pieces, dropout, 7)
        todo = [(u, d) for u in units for d in range(20)]
        found = list(enc.segment(todo))
        assert {(u, d): ids for u, d, ids in found} == {(u, d): enc._heap(u, d) for u, d in todo}
    calls.clear()
    ids = dict((u, i) for u, _, i in Encoder(pieces, 0.0, 7).segment([("▁recommendation", 0)]))["▁recommendation"]
    # the first offers, then one look for both neighbours of a merge
    assert len(calls) == 1 + len("▁recommendation") - len(ids)
