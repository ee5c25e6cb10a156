"""Entry point for spark-submit: ``spark-submit run.py gold --lake hdfs:///bank``."""

from clientlens.cli import main

if __name__ == "__main__":
    main()
