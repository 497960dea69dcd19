"""What Python workers take and keep."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from docketframe.llm import arrays, packing


def words(text: str) -> arrays.Words:
    data, sizes = arrays.joined(pa.array([text]))
    return arrays.Words(np.frombuffer(data, np.uint8), sizes, arrays.BLANK_SEPARATED, lower=True)


def test_hashing_takes_memory_by_the_slice():
    text = "einige Worte " * 230_000  # 3 MB
    data, sizes = arrays.joined(pa.array([text]))
    arrays.give_back()
    tracemalloc.start()
    try:
        arrays.Words(np.frombuffer(data, np.uint8), sizes, arrays.BLANK_SEPARATED)
        assert tracemalloc.get_traced_memory()[1] < 25 * len(data)
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("size", [1, 7, 64])
def test_hashes_do_not_depend_on_the_slices(monkeypatch, size):
    text = "ein Wort und ein sehrlangeswortdaslaengeristalseineScheibe und EIN Wort  \n mehr"
    whole = words(text).hash
    monkeypatch.setattr(arrays, "HASHED_BYTES", size)
    assert (words(text).hash == whole).all()
    assert len(words("").hash) == 0
    assert whole[0] == whole[3] == whole[6]


def test_a_task_that_gives_back_drops_what_other_operators_keep(monkeypatch):
    monkeypatch.setitem(packing._TOKENIZERS, "some path", object())
    words("ein Wort")
    assert arrays._powers.cache_info().currsize
    arrays.give_back()
    assert not packing._TOKENIZERS and not arrays._powers.cache_info().currsize
