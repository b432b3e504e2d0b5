"""Where the public vocabulary files are installed."""

import public_tokenizers


def tokenizer_path(name: str) -> str:
    """The path of a file on this machine and, as a package, on every executor."""
    return public_tokenizers.path(name)
