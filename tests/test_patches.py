"""Search and replace blocks whose white space differs from the text."""

import pytest

from folioflow.operators import spans as S

BLOCK = "<<<<<<< SEARCH\n{}\n=======\nNEW\n>>>>>>> REPLACE"


@pytest.mark.parametrize("gap", ["  ", "\t", "\n", " \n\t "])
def test_any_white_space_between_tokens(gap):
    assert S.apply_patches(f"a one{gap}two three z", BLOCK.format("one two three")) == ("a NEW z", [])


def test_unique_or_refused():
    text = "one  two. one\ttwo"
    assert S.apply_patches(text, BLOCK.format("one two")) == (text, ["one two"])
    assert S.apply_patches("f( x )", BLOCK.format("f(x)")) == ("NEW", [])
    assert S.apply_patches("one three", BLOCK.format("one two")) == ("one three", ["one two"])
