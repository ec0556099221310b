import os

import pytest


@pytest.fixture(scope="session")
def larger(sf_dir):
    """Tables large enough to learn from."""
    path = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    return path if os.path.isdir(path) else sf_dir
