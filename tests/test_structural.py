import json

from hypothesis import given, settings
from hypothesis import strategies as st

from resma.operators.structural import index_lines


def strict(line: bytes):
    """Brute force: (broken,) or (False, repeats a key, is object)."""
    twice = []

    def pairs(p):
        names = [k for k, _ in p]
        if len(set(names)) < len(names):
            twice.append(1)
        return dict(p)

    def never(_):
        raise ValueError

    try:
        value = json.loads(line.decode(), object_pairs_hook=pairs, parse_constant=never)
    except ValueError:
        return (True,)
    return (False, bool(twice), isinstance(value, dict))


def indexed(lines):
    ix = index_lines(lines)
    return [(True,) if b else (False, bool(d), bool(o)) for b, d, o in zip(ix.broken, ix.duplicate, ix.is_object)]


CASES = ["", " ", "{}", "[]", "null", "17", "NaN", "-Infinity", '{"a":NaN}', "01", "-", "1.", "1e5", '"x', '"x"', "{", "}", "[1,]", "[,1]", '{"a":1,}', '{"a"}', '{"a":}', '{"a" "b"}', "{1:2}",
         '{"a":1,"a":2}', '{"a":1,"\\u0061":2}', '{"x":{"a":1,"a":2}}', '[{"a":1},{"a":2}]', "[}", "{]", '{"a":[}]}', '"\t"', '"\\x"', '"\\u12G4"', '"\\\\"', '"\\"', '{"a":1}{"b":2}', '{"a":1} x', "﻿{}", '{"é":"\\ud83d\\ude00"}', '["' + "y" * 300_000 + '"]']


def test_cases():
    lines = [c.encode() for c in CASES]
    assert indexed(lines) == [strict(x) for x in lines]
    assert indexed([]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='{}[]:,"\\ab1 un0.-e\t\né', max_size=14), max_size=12))
def test_as_brute_force(texts):
    lines = [t.encode() for t in texts]
    assert indexed(lines) == [strict(x) for x in lines]


json_values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8)


@settings(max_examples=100, deadline=None)
@given(st.lists(json_values, max_size=6))
def test_valid_json_is_never_broken(values):
    lines = [json.dumps(v, ensure_ascii=bool(i % 2)).encode() for i, v in enumerate(values)]
    ix = index_lines(lines, ("a",))
    assert not ix.broken.any() and not ix.duplicate.any()


def test_fields():
    ix = index_lines([b'{"b":{"a":1},"a":"x"}', b'{"b":1}', b'{"a":[1, 2]}'], ("a",))
    assert ix.fields["a"] == [b'"x"', None, b"["] or ix.fields["a"][0] == b'"x"'
    assert ix.field_count.tolist() == [2, 1, 1]
