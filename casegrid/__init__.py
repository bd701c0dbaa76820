"""Analytics over geo-tagged incident records, written as DataFrame-to-DataFrame functions."""
