"""DataFrame -> DataFrame operators; no actions inside except bounded size checks."""
