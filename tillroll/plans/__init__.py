"""Physical-strategy helpers and the job entry points."""
