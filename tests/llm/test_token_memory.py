"""The token memories hold a partition's units, within their bound."""

from martforge.llm import tokens


def test_units_of_a_partition_are_encoded_once():
    enc = tokens.UnitEncoder(tokens.model_path(tokens.MODEL))
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"q{letters[i // 17576 % 26]}{letters[i // 676 % 26]}{letters[i // 26 % 26]}{letters[i % 26]}{end}"
             for i in range(100_000) for end in ("", ",")]
    text = " ".join(words).encode()
    encoded = []
    tokenize = enc.units._run
    enc.units._run = lambda run: encoded.append(run) or tokenize(run)
    first = enc.ids(text)
    assert len(encoded) >= 100_000
    encoded.clear()
    assert enc.ids(text) == first and not encoded
    assert enc.units.used <= enc.units.half
    some = words[::997]
    want = enc.tok.encode(" ".join(some), add_special_tokens=False).ids
    assert enc.ids(" ".join(some).encode()) == b"".join(i.to_bytes(4, "little") for i in want)
