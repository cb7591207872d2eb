"""Named queries over the test tables, and the presets they use."""
