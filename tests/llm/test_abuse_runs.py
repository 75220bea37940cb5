import pytest

pytest.importorskip("seedwork.llm")
from seedwork.llm import abuse  # noqa: E402


@pytest.mark.parametrize("before", [0, 390, 397, 700])
def test_long_runs_of_single_letters_are_searched(before):
    text = " ".join("z" * before + "motherfucker" + "z" * 500)
    m = abuse.matcher()
    assert any(abuse.letters("motherfucker") in f for f in m.sentences(text))
