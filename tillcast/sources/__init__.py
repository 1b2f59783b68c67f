"""Reading inputs, writing outputs, and the star-schema testbed."""
