"""Rules of sites as data, and the one job that applies them."""
