"""Reading captures, images and request logs; writing observations and archives."""
