"""Entry script for spark-submit."""

from marketbars.cli import main

if __name__ == "__main__":
    main()
