import numpy as np
import pytest

from tradewind.llm.token_files import HEAD, pack_block, unpack_block


@pytest.mark.parametrize("bits", [0, 1, 7, 8, 9, 16, 17, 24, 25, 31, 32])
def test_blocks_of_every_width_come_back(bits):
    draw = np.random.default_rng(bits)
    ids = (draw.integers(0, 2**bits, 3000) if bits else np.zeros(3000, np.int64)).astype("<u4")
    block = pack_block(ids)
    assert HEAD.unpack_from(block)[3] <= bits
    assert np.array_equal(unpack_block(memoryview(block)), ids)
