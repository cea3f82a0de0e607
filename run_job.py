"""Entry point for spark-submit; see strataflow/jobs.py."""

from strataflow.jobs import main

if __name__ == "__main__":
    main()
