"""No known sentence can miss the gate of the licence scan, wherever its lines break."""

from breachline.llm.licenses import ANCHORS, SENTENCES


def test_every_wrapped_sentence_holds_an_anchor():
    for listed in SENTENCES.values():
        for sentence in listed:
            words = sentence.split()
            for i in range(1, len(words)):
                wrapped = " ".join(words[:i]) + "\n" + " ".join(words[i:])
                assert any(a in wrapped for a in ANCHORS), wrapped
            assert any(a in "\n".join(words) for a in ANCHORS), sentence
