"""Where retail tables come from and go to."""
