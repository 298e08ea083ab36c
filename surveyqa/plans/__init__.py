"""The jobs: validation, cleaning, productivity and the full run."""
