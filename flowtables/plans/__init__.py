"""Jobs: transformations of a whole feed, and the writes around them."""
