from tests.conftest import make, spark  # noqa: F401  the same session
