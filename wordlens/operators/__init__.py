from wordlens.operators import bloom, cms, counts, urls  # noqa: F401
