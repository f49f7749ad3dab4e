"""spark-submit entry: ``spark-submit --py-files tallyglass.zip job.py batch --config ... --as-of ...``"""

from tallyglass.__main__ import main

if __name__ == "__main__":
    main()
