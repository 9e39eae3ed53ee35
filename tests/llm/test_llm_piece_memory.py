"""The encoders' memory holds bare words once, and pieces with closing marks beside them."""

from tokenizers import Tokenizer

from haulier.llm.queries import tokenizer_path
from haulier.llm.tokens import Encoder


def test_a_bare_word_is_kept_once():
    path = tokenizer_path("byte_bpe_50k.json")
    encoder, text = Encoder(path), "zorgel zorgel, zorgel. quambly! 12. a), quambly"
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert encoder.encode([text])[0] == encoder._bytes(want)
    held = [memory for memory in vars(encoder).values() if isinstance(memory, type(encoder._pieces))]
    assert len(held) == 1 and set(held[0].new) == {"\0zorgel", "zorgel", "zorgel,", "zorgel.", "quambly!", "quambly", "12.", "a),"}
    assert encoder.encode([text])[0] == encoder._bytes(want)
