"""DataFrame-in, DataFrame-out operators over events, panels and scored rows."""
