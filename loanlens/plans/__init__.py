"""Physical-plan helpers (checked broadcast, semi-join reduction) and persistence of the cohort."""
