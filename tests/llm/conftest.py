import os

import pytest

from platemark.llm import vocab


@pytest.fixture(scope="session")
def ranks():
    path = vocab.vocabulary_path()
    if not os.path.exists(path):
        pytest.skip("no vocabulary files")
    return vocab.load_ranks(path)
