"""Frame-to-frame operators; chain them with ``DataFrame.transform``."""
