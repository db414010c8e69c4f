"""Entry point for spark-submit; see ``python -m vigia --help``."""

from vigia.__main__ import main

if __name__ == "__main__":
    main()
