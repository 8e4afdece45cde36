"""What to load and how: schemas, load specs, load jobs and their audit."""
