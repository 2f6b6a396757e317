"""Entry point for spark-submit; see ``comptoir.plans.runner``."""

from comptoir.plans.runner import main

if __name__ == "__main__":
    main()
