"""Table specifications and the jobs built from them."""
