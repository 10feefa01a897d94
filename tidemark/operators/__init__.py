"""DataFrame operators: apply, journal, temporal, validation, control."""
