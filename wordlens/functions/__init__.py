from wordlens.functions.hashing import hash_bucket, hash_pair, position, with_hash_pair  # noqa: F401
from wordlens.functions.text import (  # noqa: F401
    DELIMITER,
    clean_words,
    cleaned_text,
    comma_list,
    page_description,
    remove_stop_words,
    split_tokens,
    tokenize,
    url_short_name,
)
