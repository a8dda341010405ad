"""Category tags, all in lower case."""

# A venue serves food or drink when one of its tags is in this list.
FOOD_AND_DRINK_TAGS = [
    "restaurants", "food", "bars", "pubs", "sports bars", "dive bars", "cocktail bars", "wine bars",
    "breweries", "brewpubs", "wineries", "distilleries", "coffee & tea", "cafes",
    "juice bars & smoothies", "bubble tea", "desserts", "ice cream & frozen yogurt", "bakeries",
    "patisserie/cake shop", "food trucks", "food stands", "caterers", "personal chefs", "diners",
    "fast food", "pizza", "burgers", "sandwiches", "sushi bars", "steakhouses", "seafood", "buffets",
    "creperies", "waffles",
]

# Tags offered as cuisines.
CUISINE_TAGS = [
    "mexican", "italian", "chinese", "japanese", "thai", "indian", "french", "mediterranean", "greek",
    "spanish", "vietnamese", "korean", "american (traditional)", "american (new)", "southern",
    "cajun/creole", "middle eastern", "latin american", "caribbean", "hawaiian", "filipino",
    "taiwanese", "cantonese", "szechuan", "dim sum", "ethiopian", "african", "german", "irish",
    "british", "turkish", "persian/iranian", "pakistani", "portuguese", "scandinavian", "pizza",
    "burgers", "sandwiches", "tacos", "sushi bars", "sushi", "ramen", "steakhouses", "seafood",
    "barbeque", "chicken wings", "chicken shop", "hot dogs", "cheesesteaks", "wraps", "salad", "soup",
    "poke", "waffles", "creperies", "fondue", "tapas/small plates", "hot pot", "buffets",
    "comfort food", "soul food", "gastropubs", "diners", "fast food", "food trucks", "food stands",
    "caterers", "breakfast & brunch", "brunch", "wine bars", "cocktail bars", "sports bars",
    "dive bars", "pubs", "breweries", "brewpubs", "wineries", "distilleries", "sake bars",
    "whiskey bars", "beer gardens", "coffee & tea", "cafes", "juice bars & smoothies", "bubble tea",
    "tea rooms", "desserts", "ice cream & frozen yogurt", "bakeries", "patisserie/cake shop",
    "cupcakes", "donuts", "candy stores", "chocolatiers & shops", "gelato", "delis", "acai bowls",
    "empanadas", "falafel", "gyros", "kebab", "noodles", "dumplings", "bagels", "fish & chips",
]
