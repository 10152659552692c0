"""Generic operators; column names are arguments, so they fit any table."""
