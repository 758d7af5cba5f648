"""Where quotes come from and go to."""
