"""spark-submit entry: ``spark-submit --py-files tessera.zip run_query.py query|dispatch ...``
(see ``tessera.run``)."""

from tessera.run import main

if __name__ == "__main__":
    main()
