"""Resource models, materialisation, mirror, push and the whole cycle."""
